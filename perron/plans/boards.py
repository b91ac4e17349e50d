"""Live departure and arrival boards of one station.

Inputs are the live logs: the append-only run-tracking log (C6) and the
SCD2 disruption log (C5). Instants are stored in UTC and converted to the
station's zone once, here (finding 12); ``now`` is the local wall time.

* latest version per (date, train, station) among versions whose local
  time is inside ``now - 5 min .. now + 8 h`` (the filter is inside the
  ranked set, as in the reference);
* route ends from the plan, names left-joined (finding 19);
* via stations: stops after (departures) or before (arrivals) the station,
  excluding the route end; built from plan rows with a running count of
  the station's calls instead of an all-pairs self join;
* active disruptions of the last 24 h per run and station, text from the
  dictionary with station placeholders filled, joined by ' | ' in snapshot
  order; matched on (date, schedule, order, station) (finding 10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perron.functions.ordered import top1
from perron.plans.silver_model import Silver

DASH = "—"
TS = "yyyy-MM-dd HH:mm:ss"
# Board status texts.
CANCELLED, DEPARTED, ARRIVED, DELAYED, ON_TIME = "ODWOŁANY", "ODJECHAŁ", "PRZYJECHAŁ", "OPÓŹNIONY", "PLANOWY"


def _ends(s: Silver) -> DataFrame:
    st = s.def_station.select("id", "name")
    e = s.schedule_details.groupBy("schedule_id", "order_id").agg(
        F.min(F.struct("order_number", "dsta_id")).alias("f"), F.max(F.struct("order_number", "dsta_id")).alias("l"))
    e = e.select("schedule_id", "order_id", F.col("f.order_number").alias("first_seq"),
                 F.col("l.order_number").alias("last_seq"), F.col("f.dsta_id").alias("station_id_start"),
                 F.col("l.dsta_id").alias("station_id_end"))
    return (e.join(st.select(F.col("id").alias("station_id_start"), F.col("name").alias("station_start")),
                   "station_id_start", "left")
            .join(st.select(F.col("id").alias("station_id_end"), F.col("name").alias("station_end")),
                  "station_id_end", "left"))


def _vias(s: Silver, ends: DataFrame, station_id, after: bool) -> DataFrame:
    """Intermediate stations, one list per plan (multiplicity = calls at the station before/after)."""
    sd = s.schedule_details.select("schedule_id", "order_id", "order_number", "dsta_id")
    here = (F.col("dsta_id") == station_id).cast("int")
    if after:
        w = Window.partitionBy("schedule_id", "order_id").orderBy("order_number").rowsBetween(
            Window.unboundedPreceding, -1)
        keep = F.col("order_number") < F.col("last_seq")
    else:
        w = Window.partitionBy("schedule_id", "order_id").orderBy("order_number").rowsBetween(
            1, Window.unboundedFollowing)
        keep = F.col("order_number") > F.col("first_seq")
    plans = sd.filter(F.col("dsta_id") == station_id).select("schedule_id", "order_id").distinct()
    x = sd.join(plans, ["schedule_id", "order_id"], "left_semi").withColumn(
        "_n", F.coalesce(F.sum(here).over(w), F.lit(0)))
    x = x.join(ends.select("schedule_id", "order_id", "first_seq", "last_seq"), ["schedule_id", "order_id"])
    st = s.def_station.select(F.col("id").alias("dsta_id"), F.col("name").alias("_name"))
    x = x.filter(keep & (F.col("_n") > 0)).join(st, "dsta_id", "left").filter(F.col("_name").isNotNull())
    x = x.select("schedule_id", "order_id", "order_number", F.explode(F.array_repeat("_name", F.col("_n").cast("int")))
                 .alias("_name"))
    return x.groupBy("schedule_id", "order_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("order_number", "_name"))), lambda e: e["_name"]), ", ")
        .alias("stacje_posrednie"))


def _disruption_texts(s: Silver, dis_log: DataFrame, ends: DataFrame, now, zone: str) -> DataFrame:
    d = dis_log.filter(F.col("is_active") & (F.from_utc_timestamp("snapshot_ts", zone)
                                             >= F.lit(now).cast("timestamp") - F.expr("INTERVAL 24 HOURS")))
    dc = s.def_disruption_cause.select(F.lower("code").alias("_lc"), "description")
    d = d.join(dc, F.lower(F.coalesce("message", "disruption_type_code")) == F.col("_lc"), "left")
    d = d.join(ends.select("schedule_id", "order_id", "station_start", "station_end"), ["schedule_id", "order_id"],
               "left")
    txt = F.coalesce("description", "message", "disruption_type_code")
    txt = F.replace(F.replace(txt, F.lit("{stacja_poczatkowa}"), F.coalesce("station_start", F.lit(DASH))),
                    F.lit("{stacja_koncowa}"), F.coalesce("station_end", F.lit(DASH)))
    d = d.withColumn("_t", txt).filter(F.col("_t").isNotNull())
    return d.groupBy("schedule_id", "order_id", "operating_date", "dsta_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("snapshot_ts", "_t"))), lambda e: e["_t"]), " | ").alias("utrudnienia"))


def board(s: Silver, ops_log: DataFrame, dis_log: DataFrame, now: str, station_id, kind: str,
          zone: str = "Europe/Warsaw") -> DataFrame:
    """H14 (``kind='dep'``) / H15 (``kind='arr'``) live board at ``now`` (local wall time)."""
    import datetime as dt
    now_ts = F.lit(now).cast("timestamp")
    today = dt.datetime.fromisoformat(now).date()
    t_col = "actual_departure" if kind == "dep" else "actual_arrival"
    local = F.from_utc_timestamp(t_col, zone)
    lg = ops_log.filter((F.col("dsta_id") == station_id)
                        & (F.col("operating_date") >= F.lit(today - dt.timedelta(days=1)))
                        & local.between(now_ts - F.expr("INTERVAL 5 MINUTES"), now_ts + F.expr("INTERVAL 8 HOURS")))
    lg = top1(lg, ["operating_date", "train_order_id", "dsta_id"],
              [("snapshot_ts", "desc"), ("actual_sequence", "desc")])
    sh = s.schedule_header.select("operating_date", "schedule_id", "order_id", "train_order_id", "carrier_code",
                                  "category_code", "name", "national_number")
    sd = s.schedule_details.select("schedule_id", "order_id", "dsta_id", "arrival_time", "arrival_day",
                                   "departure_time", "departure_day", "departure_platform", "departure_track")
    # the log's rows that the board's can meet: a filter on the key of the log, so it comes before the log's grouping
    dis_log = dis_log.filter((F.col("dsta_id") == station_id) & (F.col("operating_date") >= F.lit(today - dt.timedelta(days=1))))
    ends = _ends(s)
    x = (lg.join(sh, ["operating_date", "schedule_id", "order_id", "train_order_id"], "inner")
         .join(sd, ["schedule_id", "order_id", "dsta_id"], "inner"))
    x = x.filter(F.col("departure_time" if kind == "dep" else "arrival_time").isNotNull())
    x = (x.join(ends, ["schedule_id", "order_id"], "left")
         .join(_vias(s, ends, station_id, after=(kind == "dep")), ["schedule_id", "order_id"], "left")
         .join(_disruption_texts(s, dis_log, ends, now, zone),
               ["operating_date", "schedule_id", "order_id", "dsta_id"], "left"))
    dep_l = F.from_utc_timestamp("actual_departure", zone)
    arr_l = F.from_utc_timestamp("actual_arrival", zone)

    def to_go(c):
        return F.round((F.unix_timestamp(c) - F.unix_timestamp(now_ts)) / 60.0).cast("bigint")

    common = [F.col("carrier_code").alias("przewoznik"), F.col("category_code").alias("kategoria"),
              F.col("name").alias("nazwa_pociagu"), F.col("national_number").alias("nr_pociagu"),
              F.col("station_start").alias("stacja_poczatkowa"), F.col("station_end").alias("stacja_koncowa"),
              "stacje_posrednie", F.col("departure_platform").alias("peron"), F.col("departure_track").alias("tor")]
    if kind == "dep":
        status = (F.when(F.col("is_cancelled"), CANCELLED).when(dep_l <= now_ts, DEPARTED)
                  .when(F.col("departure_delay_min") > 5, DELAYED).otherwise(ON_TIME))
        return x.select(
            F.date_format(F.date_add("operating_date", F.coalesce("departure_day", F.lit(0))), "yyyy-MM-dd")
            .alias("planowy_odjazd_dzien"),
            F.col("departure_time").alias("planowy_odjazd_godzina"),
            F.col("arrival_time").alias("planowy_przyjazd_godzina"), *common,
            F.col("departure_delay_min").alias("opoznienie_min"), status.alias("status"),
            to_go(dep_l).alias("do_odjazdu_min"), F.date_format(dep_l, TS).alias("faktyczny_odjazd"), "utrudnienia")
    end_here = F.col("station_id_end") == F.col("dsta_id")
    status = (F.when(F.col("is_cancelled"), CANCELLED).when(dep_l <= now_ts, DEPARTED).when(arr_l <= now_ts, ARRIVED)
              .when(F.col("arrival_delay_min") > 5, DELAYED).otherwise(ON_TIME))
    return x.select(
        F.date_format(F.date_add("operating_date", F.coalesce("arrival_day", F.lit(0))), "yyyy-MM-dd")
        .alias("planowy_przyjazd_dzien"),
        F.col("arrival_time").alias("planowy_przyjazd_godzina"), *common,
        F.col("arrival_delay_min").alias("opoznienie_przyjazd_min"), status.alias("status"),
        to_go(arr_l).alias("do_przyjazdu_min"), F.date_format(arr_l, TS).alias("faktyczny_przyjazd"),
        F.when(~end_here | end_here.isNull(), F.date_format(
            F.date_add("operating_date", F.coalesce("departure_day", F.lit(0))), "yyyy-MM-dd"))
        .alias("planowy_odjazd_dzien"),
        F.when(~end_here | end_here.isNull(), F.col("departure_time")).alias("planowy_odjazd_godzina"),
        F.col("departure_delay_min").alias("opoznienie_odjazdu_min"), to_go(dep_l).alias("do_odjazdu_min"),
        F.date_format(dep_l, TS).alias("faktyczny_odjazd"), "utrudnienia")
