"""Registry of named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query builds the silver shapes from the driver tables (see
``sources.fixtures``) and runs one operator or job of the engine over the
whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window

from perron.plans import gold_facts as G
from perron.plans import reports as H
from perron.plans.silver_model import Silver
from perron.session import SCRATCH_CODEC, scratch, size_shuffles
from perron.sources.fixtures import AS_OF, STATION_ID

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

# Whole fixture: as_of 2001-08-02, ten days back covers every operating date.
FULL_DAYS = 10


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


_SILVER: dict = {}


def _silver(spark: SparkSession, sf_dir: str) -> Silver:
    """One silver bundle per (session, input dir): its plans are built once and
    shared by every query of the session (the driver bridge is the slow part
    of building a plan; the data work is not shared or cached)."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _SILVER:
        size_shuffles(spark, [f"{sf_dir}/{t}.parquet" for t in ("customer", "supplier", "part", "orders", "lineitem", "events")])
        _SILVER[key] = Silver.from_fixture(spark, sf_dir)
    return _SILVER[key]


def _win() -> G.Window_:
    return G.Window_.days_back(AS_OF, FULL_DAYS)


@query("g10_run_daily")
def g10(spark, sf_dir):
    return G.run_daily(_silver(spark, sf_dir), _win())


@query("g14_run_monthly")
def g14(spark, sf_dir):
    return G.run_monthly(G.run_daily(_silver(spark, sf_dir), _win()))


@query("h4_punctuality_monthly")
def h4(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return H.punctuality_monthly(s, G.run_monthly(G.run_daily(s, _win())))


@query("g11_stop_daily")
def g11(spark, sf_dir):
    return G.stop_daily(_silver(spark, sf_dir), _win())


@query("g12_dep_daily")
def g12(spark, sf_dir):
    return G.dep_daily(_silver(spark, sf_dir), _win())


@query("g13_disruption_daily")
def g13(spark, sf_dir):
    return G.disruption_daily(_silver(spark, sf_dir), _win())


@query("g15_stop_monthly")
def g15(spark, sf_dir):
    return G.stop_monthly(G.stop_daily(_silver(spark, sf_dir), _win()))


@query("g16_disruption_monthly")
def g16(spark, sf_dir):
    return G.disruption_monthly(G.disruption_daily(_silver(spark, sf_dir), _win()))


@query("g17_dep_monthly")
def g17(spark, sf_dir):
    return G.dep_monthly(G.dep_daily(_silver(spark, sf_dir), _win()))


def _facts(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s, _win()


@query("h5_punctuality_by_daytype_monthly")
def h5(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.punctuality_by_daytype_monthly(s, G.run_monthly(G.run_daily(s, w)))


@query("h6_status_share_monthly")
def h6(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.status_share_monthly(s, G.run_monthly(G.run_daily(s, w)))


@query("h7_stop_hourly_monthly")
def h7(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.stop_hourly_monthly(s, G.stop_monthly(G.stop_daily(s, w)))


@query("h8_disruption_causes_monthly")
def h8(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.disruption_causes_monthly(s, G.disruption_monthly(G.disruption_daily(s, w)))


@query("h9_run_route")
def h9(spark, sf_dir):
    return H.run_route(_silver(spark, sf_dir))


@query("h10_station_hourly_monthly")
def h10(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.station_hourly_monthly(s, G.stop_monthly(G.stop_daily(s, w)), G.dep_monthly(G.dep_daily(s, w)),
                                    STATION_ID)


@query("h11_station_weekday_monthly")
def h11(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.station_weekday_monthly(G.stop_daily(s, w), G.dep_daily(s, w), STATION_ID)


@query("h12_station_directions_monthly")
def h12(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.station_directions_monthly(s, G.stop_monthly(G.stop_daily(s, w)),
                                        G.dep_monthly(G.dep_daily(s, w)), STATION_ID)


@query("h13_station_disruptions_monthly")
def h13(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return H.station_disruptions_monthly(s, G.disruption_daily(s, w), STATION_ID)


# ---- trace views -------------------------------------------------------------
from perron.plans import traces as T  # noqa: E402


@query("h1_run_daily_trace")
def h1(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return T.run_daily_trace(s, G.run_daily(s, w))


@query("h2_stop_daily_trace")
def h2(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return T.stop_daily_trace(s, G.stop_daily(s, w))


@query("h3_disruption_daily_trace")
def h3(spark, sf_dir):
    s, w = _facts(spark, sf_dir)
    return T.disruption_daily_trace(s, G.disruption_daily(s, w))


# ---- dimensions ----------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from perron.plans import gold_dims as D  # noqa: E402


@query("f1_d_date")
def f1(spark, sf_dir):
    s = _silver(spark, sf_dir)
    d = D.d_date_covering(s.operation_header, "operating_date")
    return d.withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd"))


@query("f2_d_hour")
def f2(spark, sf_dir):
    """Hour dimension with the number of planned departures per hour."""
    s = _silver(spark, sf_dir)
    used = (s.schedule_details.filter(F.col("departure_time").isNotNull())
            .groupBy(F.substring("departure_time", 1, 2).cast("int").alias("id"))
            .agg(F.count(F.lit(1)).alias("planned_departures")))
    return D.d_hour(spark).join(used, "id", "left").select(
        "id", "hour_label", "part_of_day", F.coalesce("planned_departures", F.lit(0)).alias("planned_departures"))


@query("f3_d_station")
def f3(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return D.d_station(s.def_station, s.def_city)


@query("f4_d_route")
def f4(spark, sf_dir):
    return D.d_route(_silver(spark, sf_dir).schedule_details)


@query("f4_d_route_daily")
def f4d(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return D.d_route(s.schedule_details, s.schedule_header, day="2001-07-27")


@query("f5_d_train_type")
def f5(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return G.train_types(s).select(
        "category_code", "category_name", "speed_category_code", "carrier_code", "carrier_name",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"))


@query("f6_d_train_status")
def f6(spark, sf_dir):
    return D.d_train_status(_silver(spark, sf_dir).def_train_status)


@query("f7_d_disruption_cause")
def f7(spark, sf_dir):
    return D.d_disruption_cause(_silver(spark, sf_dir).def_disruption_cause)


# ---- table write patterns (C) ---------------------------------------------------
from perron.operators import tableops as C  # noqa: E402

OLD_STAMP = "2001-07-01 00:00:00"
NEW_STAMP = "2001-08-02 06:00:00"


def _supplier_merge(spark, sf_dir):
    """Stored suppliers (keys not divisible by 3) merged with the full feed,
    in which names of keys divisible by 5 changed."""
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    target = sup.filter(F.col("s_suppkey") % 3 != 0).select(
        "s_suppkey", "s_name", "s_nationkey", F.lit(OLD_STAMP).cast("timestamp").alias("loaded_at"))
    source = sup.select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, F.concat("s_name", F.lit(" (nowa)")))
                        .otherwise(F.col("s_name")).alias("s_name"), "s_nationkey")
    return C.merge_upsert(target, source, ["s_suppkey"], ["s_name", "s_nationkey"], NEW_STAMP)


@query("c1_merge_upsert")
def c1(spark, sf_dir):
    new_target, _ = _supplier_merge(spark, sf_dir)
    return new_target.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query("c10_audit_changes")
def c10(spark, sf_dir):
    _, changes = _supplier_merge(spark, sf_dir)
    a = C.audit_changes(changes, "supplier", ["s_suppkey"], ["s_name", "s_nationkey"], NEW_STAMP)
    return a.withColumn("changed_at", F.date_format("changed_at", "yyyy-MM-dd HH:mm:ss"))


@query("c2_insert_new")
def c2(spark, sf_dir):
    """Plan stops of days after 2001-07-27 inserted into a table holding the earlier days;
    the batch is every raw stop row (duplicates included), first row per key wins."""
    s = _silver(spark, sf_dir)
    fx = s.extra["fixture"]
    stored = s.schedule_details.join(
        s.schedule_header.filter(F.col("operating_date") <= "2001-07-27").select("schedule_id", "order_id"),
        ["schedule_id", "order_id"], "left_semi").select("schedule_id", "order_id", "order_number", "dsta_id")
    raw = fx.stop_raw().select(
        F.lit(2001).cast("bigint").alias("schedule_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_number"), (F.col("l_suppkey") % 10).alias("dsta_id"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    new = C.insert_new(stored, raw, ["schedule_id", "order_id", "order_number"],
                       order_by=["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return new.select("schedule_id", "order_id", "order_number", "dsta_id")


@query("c3_deactivate_missing")
def c3(spark, sf_dir):
    """Cities not named by any station of the feed become inactive."""
    s = _silver(spark, sf_dir)
    target = s.def_city.withColumn("is_active", F.lit(True))
    batch = s.def_station.select(F.col("dcit_id").alias("id"))
    return C.deactivate_missing(target, batch, ["id"])


@query("c4_sync_flag")
def c4(spark, sf_dir):
    """Timetable headers re-sent for 2001-07-26..30 without cancelled runs: flags
    flip inside that window only."""
    s = _silver(spark, sf_dir)
    fx = s.extra["fixture"]
    target = s.schedule_header.select("operating_date", "schedule_id", "order_id", "train_order_id", "is_active")
    batch = (fx.runs().filter((F.col("train_status") != "X")
                              & F.col("operating_date").between("2001-07-26", "2001-07-30"))
             .select("operating_date", "schedule_id", "order_id", "train_order_id"))
    out = C.sync_flag(target, batch, ["operating_date", "schedule_id", "order_id", "train_order_id"],
                      "operating_date")
    return out.withColumn("operating_date", F.date_format("operating_date", "yyyy-MM-dd"))


def _stale(df, cols):
    return df.select(*[(F.col(c) + 1000).alias(c) if c == "runs_count" else F.col(c) for c in cols])


@query("c7_recompute_days")
def c7(spark, sf_dir):
    """Daily fact whose last three days hold stale rows, recomputed for those days."""
    s, w = _facts(spark, sf_dir)
    full = G.run_daily(s, w)
    recent = G.Window_.days_back(AS_OF, 3)
    lo, hi = int(recent.date_from.strftime("%Y%m%d")), int(recent.date_to.strftime("%Y%m%d"))
    stale = _stale(full, full.columns)      # previous load: wrong counts everywhere ...
    old = full.filter(~F.col("date_id").between(lo, hi)).unionByName(
        stale.filter(F.col("date_id").between(lo, hi)))   # ... of which the window is still stored
    return C.recompute_days(old, G.run_daily(s, recent), "date_id", lo, hi)


@query("c8_recompute_months")
def c8(spark, sf_dir):
    """Monthly fact with stale months rebuilt from the daily fact (window widened to months)."""
    s, w = _facts(spark, sf_dir)
    monthly = G.run_monthly(G.run_daily(s, w))
    recent = G.Window_.days_back(AS_OF, 3)
    old = _stale(monthly, monthly.columns)
    return C.recompute_months(old, monthly, "month", recent.date_from, recent.date_to)


@query("c9_insert_missing")
def c9(spark, sf_dir):
    """Calendar holding only the operating dates, completed by the generator."""
    s = _silver(spark, sf_dir)
    have = D.calendar_rows(s.operation_header.select(F.col("operating_date").alias("full_date")).distinct())
    gen = D.d_date_covering(s.operation_header, "operating_date")
    out = C.insert_missing(have, gen, ["id"])
    return out.withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd"))


@query("c11_assign_ids")
def c11(spark, sf_dir):
    """Route ids: routes of the first day keep ids 1..n, new routes continue after the max."""
    s = _silver(spark, sf_dir)
    first = D.d_route(s.schedule_details, s.schedule_header, day="2001-07-23")
    existing = C.assign_ids(spark.createDataFrame([], "id bigint, from_station_id bigint, to_station_id bigint"),
                            first, ["from_station_id", "to_station_id"])
    return C.assign_ids(existing, D.d_route(s.schedule_details), ["from_station_id", "to_station_id"])


@query("c12_materialize")
def c12(spark, sf_dir):
    """Monthly punctuality report refreshed into a snapshot table and read back."""
    path = C.scratch_root(spark, "c12_h4")
    return C.materialize(h4(spark, sf_dir), path)


@query("c13_publish")
def c13(spark, sf_dir):
    """Station and route dimensions published as one version; route read back via the pointer."""
    s = _silver(spark, sf_dir)
    root = C.scratch_root(spark, "c13_gold")
    C.publish(spark, root, {"d_station": D.d_station(s.def_station, s.def_city),
                            "d_route": D.d_route(s.schedule_details)})
    return C.read_current(spark, root, "d_route")


# ---- shredding and silver loaders (B, D) ----------------------------------------
from perron.operators import shred as B  # noqa: E402
from perron.plans import silver as SL  # noqa: E402
from perron.sources import payloads as P  # noqa: E402

LOAD_STAMP = "2001-08-02 06:00:00"


def _fx(spark, sf_dir):
    return _silver(spark, sf_dir).extra["fixture"]


def _empty(spark, ddl):
    return spark.createDataFrame([], ddl)


@query("b1_station_rows")
def b1(spark, sf_dir):
    x = B.explode_array(B.parse(P.stations_landing(_fx(spark, sf_dir)), "stations"), "stations")
    return x.select("id", "name")


@query("b2_route_dates")
def b2(spark, sf_dir):
    x = B.schedule_route_dates(B.parse(P.schedules_landing(_fx(spark, sf_dir)), "schedules"))
    return x.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id",
                    "order_id", "train_order_id", "name", "carrier_code", "category_code", "national_number")


@query("b3_operation_stops")
def b3(spark, sf_dir):
    x = B.operations_rows(B.parse(P.operations_landing(_fx(spark, sf_dir)), "operations"))
    ts = "yyyy-MM-dd HH:mm:ss"
    return x.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "order_id",
                    "train_status", "dsta_id", "planned_sequence", "actual_sequence",
                    F.date_format("actual_arrival", ts).alias("actual_arrival"),
                    F.date_format("actual_departure", ts).alias("actual_departure"),
                    "arrival_delay_min", "departure_delay_min", "is_confirmed", "is_cancelled")


@query("b4_disruption_rows")
def b4(spark, sf_dir):
    x = B.disruption_rows(B.parse(P.disruptions_landing(_fx(spark, sf_dir)), "disruptions"))
    return x.select("disruption_id", "disruption_type_code", "message",
                    F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id",
                    "order_id", "train_order_id", "dsta_id", "sequence_number")


@query("b5_city_members")
def b5(spark, sf_dir):
    x = B.city_members(B.parse(P.cities_landing(_fx(spark, sf_dir)), "cities"))
    return x.select("city_name", "station_count", "station_id")


@query("b6_map_entries")
def b6(spark, sf_dir):
    x = B.explode_map(B.parse(P.disruption_types_landing(_fx(spark, sf_dir)), "disruption_types"),
                      "disruptionTypes")
    return x.select(F.col("k").alias("code"), F.col("v").alias("description"))


CITY_DDL = "id bigint, name string, station_count int, is_active boolean, loaded_at timestamp"


def _cities(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return SL.load_def_city(P.cities_landing(fx), _empty(spark, CITY_DDL), LOAD_STAMP)


@query("d2_def_city")
def d2(spark, sf_dir):
    return _cities(spark, sf_dir).drop("loaded_at")


@query("d3_def_station")
def d3(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    out = SL.load_def_station(P.stations_landing(fx), P.cities_landing(fx), _cities(spark, sf_dir),
                              _empty(spark, "id bigint, name string, dcit_id bigint, loaded_at timestamp"), LOAD_STAMP)
    return out.drop("loaded_at")


@query("d6_def_train_status")
def d6(spark, sf_dir):
    out = SL.load_def_train_status(P.train_statuses_landing(_fx(spark, sf_dir)),
                                   _empty(spark, "code string, name string, loaded_at timestamp"), LOAD_STAMP)
    return out.drop("loaded_at")


@query("d7_def_disruption_cause")
def d7(spark, sf_dir):
    out = SL.load_def_disruption_cause(P.disruption_types_landing(_fx(spark, sf_dir)),
                                       _empty(spark, "code string, description string, loaded_at timestamp"),
                                       LOAD_STAMP)
    return out.drop("loaded_at")


SH_DDL = ("operating_date date, schedule_id bigint, order_id bigint, train_order_id bigint, name string, "
          "carrier_code string, category_code string, national_number string, intl_arrival_number string, "
          "intl_departure_number string, snapshot_ts timestamp, is_active int")


@query("d8_schedule_header")
def d8(spark, sf_dir):
    _, table = SL.load_schedule_header(P.schedules_landing(_fx(spark, sf_dir)), _empty(spark, SH_DDL))
    return table.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id",
                        "order_id", "train_order_id", "name", "carrier_code", "category_code", "national_number",
                        "is_active")


SD_DDL = ("schedule_id bigint, order_id bigint, order_number int, dsta_id bigint, arrival_time string, "
          "arrival_day int, arrival_platform string, arrival_track string, arrival_category string, "
          "arrival_train_no string, departure_time string, departure_day int, departure_platform string, "
          "departure_track string, departure_category string, departure_train_no string, dstty_id int")


@query("d9_schedule_details")
def d9(spark, sf_dir):
    out = SL.load_schedule_details(P.schedules_landing(_fx(spark, sf_dir)), _empty(spark, SD_DDL))
    return out.drop("snapshot_ts")


OH_DDL = ("operating_date date, schedule_id bigint, order_id bigint, train_order_id bigint, train_status string, "
          "snapshot_ts timestamp")


@query("d10_operation_header")
def d10(spark, sf_dir):
    out = SL.load_operation_header(P.operations_landing(_fx(spark, sf_dir)), _empty(spark, OH_DDL))
    return out.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id",
                      "order_id", "train_order_id", "train_status",
                      F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("snapshot_ts"))


OD_DDL = ("ophe_id bigint, operating_date date, schedule_id bigint, order_id bigint, train_order_id bigint, "
          "snapshot_ts timestamp, planned_sequence int, actual_sequence int, dsta_id bigint, "
          "actual_arrival timestamp, actual_departure timestamp, is_confirmed boolean, is_cancelled boolean, "
          "arrival_delay_min int, departure_delay_min int, dwell_time_sec bigint")


@query("d11_operation_details")
def d11(spark, sf_dir):
    landing = P.operations_landing(_fx(spark, sf_dir))
    header = SL.load_operation_header(landing, _empty(spark, OH_DDL))
    header = header.withColumn("ophe_id", C.hash_id(*SL.HEADER_KEY))
    out = SL.load_operation_details(landing, header, _empty(spark, OD_DDL))
    ts = "yyyy-MM-dd HH:mm:ss"
    return out.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "order_id",
                      "planned_sequence", "actual_sequence", "dsta_id",
                      F.date_format("actual_arrival", ts).alias("actual_arrival"),
                      F.date_format("actual_departure", ts).alias("actual_departure"),
                      "is_confirmed", "is_cancelled", "arrival_delay_min", "departure_delay_min", "dwell_time_sec")


@query("d12_disruption_header")
def d12(spark, sf_dir):
    out = SL.load_disruption_header(P.disruptions_landing(_fx(spark, sf_dir)),
                                    _empty(spark, "id bigint, disruption_type_code string, message string, "
                                                  "snapshot_ts timestamp"))
    return out.drop("snapshot_ts")


@query("d13_disruption_details")
def d13(spark, sf_dir):
    out = SL.load_disruption_details(
        P.disruptions_landing(_fx(spark, sf_dir)),
        _empty(spark, "operating_date date, schedule_id bigint, order_id bigint, dsta_id bigint, dihe_id bigint, "
                      "train_order_id bigint, sequence_number int"))
    return out.withColumn("operating_date", F.date_format("operating_date", "yyyy-MM-dd"))


# ---- live layer (E, C5, C6, D14, D15) ----------------------------------------------
from perron.plans import live as LV  # noqa: E402
from perron.sources import live_fixtures as LF  # noqa: E402


@query("e3_run_diff")
def e3(spark, sf_dir):
    """Diff of every day's user snapshot against the previous day's."""
    s = LF.user_snapshots(_fx(spark, sf_dir))
    prev = s.withColumn("day", F.date_add("day", 1))
    out = LV.diff_runs(prev, s, key=["user_id", "day"])
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "user_id", "event_type", "k_bucket",
                      "change_hash", "diff_kind")


def _dis_events(spark, sf_dir):
    rows = LF.disruption_snapshot_rows(_fx(spark, sf_dir))
    flat = LV.flatten_disruptions(rows, ["disruption_id"], ["snapshot_day"])
    last = rows.agg(F.max("snapshot_day")).scalar()
    # a record's rows in the order of their days, in one pass: the snapshot of the day before has it, or the one of the day after
    w = Window.partitionBy(*LV.DIS_KEY).orderBy("snapshot_day")
    day, after = F.col("snapshot_day"), F.date_add("snapshot_day", 1)
    x = flat.where(day.isNotNull()).select(
        *flat.columns, F.when(F.lag(day).over(w) == F.date_sub(day, 1), F.lag("change_hash").over(w)).alias("_before"), F.lead(day).over(w).eqNullSafe(after).alias("_stays"))
    changed = ~F.col("change_hash").eqNullSafe(F.col("_before"))
    # ended only for runs of the current snapshot's day on: what merely leaves the window is not
    ended = ~F.col("_stays") & (after <= last) & (F.col("operating_date") >= after)
    events = F.array_compact(F.array(F.when(changed, F.struct(day, "change_hash", F.lit("changed").alias("kind"))),
                                     F.when(ended, F.struct(after.alias("snapshot_day"), F.lit(None).cast("string").alias("change_hash"), F.lit("ended").alias("kind")))))
    return x.select(*LV.DIS_KEY, *LV.DIS_TRACKED, F.explode(events).alias("_e")).select(
        "_e.snapshot_day", *LV.DIS_KEY, *LV.DIS_TRACKED, "_e.change_hash", "_e.kind")


@query("e5_disruption_diff")
def e5(spark, sf_dir):
    """Changed and ended disruption rows of every day's snapshot against the previous one."""
    ev = _dis_events(spark, sf_dir)
    return ev.select(F.date_format("snapshot_day", "yyyy-MM-dd").alias("snapshot_day"), "kind", "schedule_id",
                     "order_id", "train_order_id", F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"),
                     "dsta_id", "sequence_number", "disruption_type_code", "message", "change_hash")


DLOG_DDL = ("operating_date date, schedule_id bigint, train_order_id bigint, dsta_id bigint, sequence_number int, "
            "order_id bigint, disruption_type_code string, message string, change_hash string, is_active boolean, "
            "snapshot_ts timestamp")


@query("d15_disruption_tracking_log")
def d15(spark, sf_dir):
    """SCD2 disruption log after applying every snapshot's changed/ended sets in order."""
    log = _dis_log(spark, sf_dir)
    return log.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "schedule_id",
                      "train_order_id", "dsta_id", "sequence_number", "order_id", "disruption_type_code", "message",
                      "change_hash", "is_active",
                      F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("snapshot_ts"))


OLOG_DDL = ("operating_date date, schedule_id bigint, order_id bigint, train_order_id bigint, dsta_id bigint, "
            "train_status string, actual_arrival timestamp, actual_departure timestamp, arrival_delay_min int, "
            "departure_delay_min int, is_confirmed boolean, is_cancelled boolean, actual_sequence int, "
            "snapshot_ts timestamp, change_hash string")


def _track_log(spark, sf_dir):
    batch = LF.track_versions(_fx(spark, sf_dir))
    log = _empty(spark, OLOG_DDL)
    new = LV.append_versions(log, batch.select(*log.columns))
    return new


@query("d14_operation_tracking_log")
def d14(spark, sf_dir):
    new = _track_log(spark, sf_dir)
    ts = "yyyy-MM-dd HH:mm:ss"
    return new.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "train_order_id",
                      "dsta_id", "train_status", F.date_format("actual_arrival", ts).alias("actual_arrival"),
                      F.date_format("actual_departure", ts).alias("actual_departure"), "arrival_delay_min",
                      "is_confirmed", "is_cancelled", "change_hash",
                      F.date_format("snapshot_ts", ts).alias("snapshot_ts"))


@query("e12_latest_versions")
def e12(spark, sf_dir):
    """Latest logged version per (date, train, station) among versions with an arrival
    between 06:00 and 18:00 of the run day (window applied before ranking)."""
    log = _track_log(spark, sf_dir)
    h = F.hour("actual_arrival")
    out = LV.latest_versions(log, h.between(6, 17), tie="actual_sequence")
    ts = "yyyy-MM-dd HH:mm:ss"
    return out.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "train_order_id",
                      "dsta_id", F.date_format("actual_arrival", ts).alias("actual_arrival"),
                      F.date_format("snapshot_ts", ts).alias("snapshot_ts"))


# ---- bronze file handling (A) ------------------------------------------------------
from perron.sources import files as A  # noqa: E402


def _ops_files(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return P.operations_landing(fx, "060000"), P.operations_landing(fx, "050000"), P.stations_landing(fx)


def _ops_names(spark, sf_dir):
    """Names of the files of both fetches, whose pages are made once, and of the dictionaries."""
    fx = _fx(spark, sf_dir)
    return P.operations_landing(fx, "060000", "050000").select("object_name").unionByName(P.stations_landing(fx).select("object_name"))


@query("a2_file_attributes")
def a2(spark, sf_dir):
    return A.with_file_attributes(_ops_names(spark, sf_dir))


@query("a3_new_files")
def a3(spark, sf_dir):
    """Files not LOADED in the manifest (days up to 07-27 loaded, 07-28 failed)."""
    late, _, _ = _ops_files(spark, sf_dir)
    files = A.with_file_attributes(late.select("object_name"))
    status = F.when(F.col("part_date") <= "20010728", "LOADED").when(F.col("part_date") == "20010729", "FAILED")
    manifest = files.select("object_name", status.alias("status")).filter(F.col("status").isNotNull())
    return A.new_files(late.select("object_name"), manifest)


@query("a8_latest_run")
def a8(spark, sf_dir):
    return A.latest_run(_ops_names(spark, sf_dir))


def _damaged_ops(spark, sf_dir):
    """Operations documents with injected faults: every 5th page loses its train ids,
    every 7th page is cut off (not JSON any more)."""
    late, _, _ = _ops_files(spark, sf_dir)
    x = A.with_file_attributes(late)
    k = F.col("page") - 1
    payload = F.when(k % 5 == 4, F.regexp_replace("payload", '"orderId":', '"orderIdX":')).otherwise(F.col("payload"))
    payload = F.when(k % 7 == 6, F.substring(payload, 1, 100)).otherwise(payload)
    return x.select("object_name", payload.alias("payload"))


@query("a7_validate")
def a7(spark, sf_dir):
    valid, bad = B.validate(_damaged_ops(spark, sf_dir), "operations")
    return valid.select("object_name", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("object_name", "reason"))


@query("a9_stitch_pages")
def a9(spark, sf_dir):
    """Live pages of one run per day; day 07-25 has an invalid page, day 07-26 lacks its
    last page: both snapshots are dropped whole."""
    late, _, _ = _ops_files(spark, sf_dir)
    x = A.with_file_attributes(B.parse(late, "operations"))
    biz = F.regexp_extract("object_name", r"operations_(\d{8})_", 1)
    last = F.max("page").over(Window.partitionBy("run_ts"))
    pages = x.select(
        "run_ts", "page", (~((biz == "20010725") & (F.col("page") == 2))).alias("valid"),
        F.when(biz == "20010726", F.lit(True)).otherwise(F.col("page") < last).alias("has_next"),
        F.col("p.generatedAt").alias("generated_at"), F.col("p.trains").alias("trains"))
    rows = A.stitch_pages(pages)
    return rows.select("run_ts", "snapshot_generated_at", F.col("train.orderId").alias("order_id"))


# ---- station and route reports (H22-H24) ------------------------------------------
from perron.plans import station_reports as SR  # noqa: E402


@query("h22_route_start_monthly")
def h22(spark, sf_dir):
    return SR.route_start_monthly(_silver(spark, sf_dir), AS_OF)


@query("h23_station_calls")
def h23(spark, sf_dir):
    return SR.station_calls(_silver(spark, sf_dir), AS_OF, STATION_ID)


@query("h24_station_disruptions")
def h24(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return SR.station_disruptions(s, SR.station_calls(s, AS_OF, STATION_ID), STATION_ID)


@query("h18_completed_runs")
def h18(spark, sf_dir):
    return SR.completed_runs(_silver(spark, sf_dir), AS_OF, STATION_ID)


@query("h19_run_disruptions")
def h19(spark, sf_dir):
    return SR.run_disruptions(_silver(spark, sf_dir), AS_OF, STATION_ID)


@query("h21_model_plan_stops")
def h21(spark, sf_dir):
    return SR.model_plan_stops(_silver(spark, sf_dir), AS_OF)


LIVE_DAY = dt.date(2001, 7, 27)   # the boards and timetables look at 2001-07-27 (future runs exist)


@query("h16_timetable_from_station")
def h16(spark, sf_dir):
    return SR.timetable_from_station(_silver(spark, sf_dir), LIVE_DAY, STATION_ID)


@query("h17_route_from_station")
def h17(spark, sf_dir):
    return SR.route_from_station(_silver(spark, sf_dir), LIVE_DAY, STATION_ID)


@query("h20_run_stops")
def h20(spark, sf_dir):
    return SR.run_stops(_silver(spark, sf_dir), AS_OF, STATION_ID)


# ---- live boards (H14, H15) -----------------------------------------------------
from perron.plans import boards as BD  # noqa: E402
from perron.sources.fixtures import LIVE_AS_OF  # noqa: E402


def _dis_log(spark, sf_dir):
    ev = _dis_events(spark, sf_dir).withColumn(
        "snapshot_ts", F.timestamp_seconds(F.unix_date("snapshot_day").cast("bigint") * 86400 + 6 * 3600))
    return LV.scd2_events(_empty(spark, DLOG_DDL), ev.withColumn("_kind", F.when(F.col("kind") == "changed", "C").otherwise("E")))


@query("h14_departures_board")
def h14(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return BD.board(s, _track_log(spark, sf_dir), _dis_log(spark, sf_dir), LIVE_AS_OF, STATION_ID, "dep")


@query("h15_arrivals_board")
def h15(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return BD.board(s, _track_log(spark, sf_dir), _dis_log(spark, sf_dir), LIVE_AS_OF, STATION_ID, "arr")


# ---- ops reports (H25, E7/E10/E11) ------------------------------------------------
from perron.plans import ops_reports as OR  # noqa: E402


def _event_steps(spark, sf_dir):
    """A step log derived from events: one pipeline run per day, one step per event
    type (start = first event, end = last event, FAILED when an error event occurred
    in that step's window)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.groupBy(F.date_format("ts", "yyyyMMdd").cast("bigint").alias("pipeline_run_id"),
                      F.col("event_type").alias("step_name")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.when(F.max((F.col("value") < 1).cast("int")) == 1, "FAILED").otherwise("SUCCESS").alias("status"))


@query("h25_step_report")
def h25(spark, sf_dir):
    return OR.step_report(_event_steps(spark, sf_dir))


@query("e11_heartbeat_log")
def e11(spark, sf_dir):
    """Heartbeat of the daily user-snapshot cycles: delta size (E3), outcome (E7),
    lag of the snapshot stamp behind the cycle time (E10), all rows kept (E11)."""
    s = LF.user_snapshots(_fx(spark, sf_dir))
    diff = LV.diff_runs(s.withColumn("day", F.date_add("day", 1)), s, key=["user_id", "day"])
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.to_date("ts").alias("day")).agg(
        F.max("ts").alias("last_ts"))
    n = diff.groupBy("day").agg(F.count(F.lit(1)).alias("delta_count"))
    cyc = ev.join(n, "day", "left").select(
        F.date_format("day", "yyyyMMdd").alias("run_ts"),
        F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("generated_at_text"),
        F.date_add("day", 1).cast("timestamp").alias("now"),
        F.coalesce("delta_count", F.lit(0)).alias("delta_count"), F.lit(False).alias("stale"),
        F.lit(None).cast("string").alias("error"))
    rows = OR.heartbeat_rows(cyc, "users")
    empty = spark.createDataFrame([], rows.schema)
    return LV.heartbeat_append(empty, rows)


# ---- fact sub-operators and live helpers as own queries (G4, G5-G9, E1, E2) ----------


@query("g4_type_version")
def g4(spark, sf_dir):
    """Train-type version valid on each run's date, else the open version."""
    s, w = _facts(spark, sf_dir)
    r = G.runs_in_window(s, w)
    return G.with_type_version(r, s).select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "order_id", "category_code",
        "carrier_code", "type_valid_from")


@query("g8_run_resolved")
def g8(spark, sf_dir):
    """Per run: route pair (G3), terminal delay (G5), planned (G7) and actual
    travel minutes, after the eligibility joins (G9)."""
    s, w = _facts(spark, sf_dir)
    return G.run_resolved(s, w).select(
        "date_id", "order_id", "from_station_id", "to_station_id", "category_code", "carrier_code",
        "type_valid_from", "status_code", "terminal_delay", "planned_travel_min", "actual_travel_min")


@query("e1_change_hash")
def e1(spark, sf_dir):
    """Canonical text and SHA-256 of every tracked stop version."""
    from perron.functions.canon import canonical_json
    t = LF.track_versions(_fx(spark, sf_dir))
    tracked = {"trainStatus": F.col("train_status"),
               "actualArrival": F.date_format("actual_arrival", LF.TS_FMT),
               "actualDeparture": F.date_format("actual_departure", LF.TS_FMT),
               "actualSequenceNumber": F.col("actual_sequence"),
               "isConfirmed": F.col("is_confirmed"), "isCancelled": F.col("is_cancelled")}
    return t.select(F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("snapshot_ts"), "train_order_id",
                    "actual_sequence", canonical_json(tracked, LV.RUN_TRACKED_TYPES).alias("canonical"),
                    "change_hash")


@query("e2_station_projection")
def e2(spark, sf_dir):
    """Each run's station entry at the station of interest, else its first station."""
    parsed = B.parse(P.operations_landing(_fx(spark, sf_dir)), "operations")
    t = parsed.select(F.explode("p.trains").alias("t"))
    st = LV.station_of_interest(F.col("t.stations"), STATION_ID)
    return t.select(F.col("t.orderId").alias("order_id"), st["stationId"].alias("station_id"),
                    st["actualSequenceNumber"].alias("actual_sequence"), st["actualArrival"].alias("actual_arrival"))


@query("b7_live_delta_rows")
def b7(spark, sf_dir):
    """Live disruption deltas written as JSON documents (one per snapshot and page of
    run ids) and shredded back (changed[*], ended[*])."""
    ev = _dis_events(spark, sf_dir)
    row = F.struct(F.col("schedule_id").alias("scheduleId"), F.col("order_id").alias("orderId"),
                   F.col("train_order_id").alias("trainOrderId"),
                   F.date_format("operating_date", "yyyy-MM-dd").alias("operatingDate"),
                   F.col("dsta_id").alias("stationId"), F.col("sequence_number").alias("sequenceNumber"),
                   F.col("disruption_type_code").alias("disruptionTypeCode"), "message",
                   F.col("change_hash").alias("changeHash"))
    docs = ev.groupBy("snapshot_day", (F.col("order_id") / P.PAGE_SIZE).cast("bigint").alias("page_key")).agg(
        F.collect_list(F.when(F.col("kind") == "changed", row)).alias("changed"),
        F.collect_list(F.when(F.col("kind") == "ended", row)).alias("ended"))
    landing = docs.select(F.concat(F.lit("live/disruptions/"), F.col("snapshot_day").cast("string"), F.lit("_p"),
                                   F.col("page_key").cast("string")).alias("object_name"),
                          F.to_json(F.struct(F.concat(F.col("snapshot_day").cast("string"), F.lit("T06:00:00Z"))
                                             .alias("generatedAt"), "changed", "ended")).alias("payload"))
    x = B.live_disruption_delta_rows(B.parse(landing, "disruptions_delta"))
    return x.select(F.substring("generated_at", 1, 10).alias("snapshot_day"), "kind", "schedule_id", "order_id",
                    "train_order_id", F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "dsta_id",
                    "sequence_number", "disruption_type_code", "message", "change_hash")


@query("c13_daily_job")
def c13_job(spark, sf_dir):
    """Two daily gold loads (as of 07-30 over 7 days, then as of 08-02 over 3 days) into
    month-partitioned fact tables; the published run fact equals a full recompute."""
    from perron.plans import jobs as J
    s = _silver(spark, sf_dir)
    root = C.scratch_root(spark, "gold")
    J.run_daily(spark, s, root, dt.date(2001, 7, 30), days=7)
    J.run_daily(spark, s, root, AS_OF, days=3)
    return C.read_current(spark, root, "f_train_run_daily").drop("month")


# ---- live operations stream (E6-E11, A7, A9 across batches, C6, D14) -------------------
from perron.streaming import live_stream as LS  # noqa: E402


def _streamed(spark, sf_dir) -> str:
    """The live operations feed run over micro-batches of pages; the folder of its tables."""
    out = scratch(spark, "live")
    pages = P.live_pages(_fx(spark, sf_dir))
    pages.write.partitionBy("batch").option("compression", SCRATCH_CODEC).parquet(f"{out}/arriving")
    pages = spark.read.parquet(f"{out}/arriving")
    for r in pages.select("batch").distinct().orderBy("batch").collect():  # the micro-batches
        LS.operations_batch(spark, pages.where(F.col("batch") == r["batch"]).select("object_name", "payload"), r["batch"], out, STATION_ID,
                            now="2001-08-02 12:00:00", max_pages=1_000_000)
    return out


@query("e9_operations_stream")
def e9(spark, sf_dir):
    """Heartbeat of the streamed feed: pages of a fetch arrive in two batches; a bad or a missing page drops the whole
    snapshot (ERR), an older stamp is STALE, no change is EMPTY, changes are OK."""
    beats = spark.read.parquet(f"{_streamed(spark, sf_dir)}/heartbeat")
    return beats.select(F.col("run_ts").cast("string").alias("run_ts"), "feed", "outcome", "delta_count", "generated_at", "lag_seconds", "error")


@query("e9_tracking_log")
def e9_log(spark, sf_dir):
    """The tracking log that the streamed feed wrote."""
    log = LS.read_log(spark, _streamed(spark, sf_dir))
    return log.select(F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "train_order_id", "dsta_id", "train_status",
                      F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("snapshot_ts"))


# ---- the silver load as one job (D1-D13, A7, C4, C13) ----------------------------------
from perron.plans import silver_job as SJ  # noqa: E402


def _landings(fx, feeds=None) -> dict:
    made = {"carriers": P.carriers_landing, "cities": P.cities_landing, "stations": P.stations_landing, "stop_types": P.stop_types_landing,
            "commercial_categories": P.categories_landing, "train_statuses": P.train_statuses_landing, "disruption_types": P.disruption_types_landing,
            "schedules": P.schedules_landing, "operations": P.operations_landing, "disruptions": P.disruptions_landing}
    return {k: f(fx) for k, f in made.items() if feeds is None or k in feeds}


def _loaded(spark, sf_dir) -> dict:
    """The layer after two loads: the first has every second fact document and cut ones, the second has all."""
    root = scratch(spark, "silver-load")
    landings = _landings(_fx(spark, sf_dir))
    for feed, docs in landings.items():  # the landing of a feed is made once, for both loads
        docs.write.option("compression", SCRATCH_CODEC).parquet(f"{root}/landing/{feed}")
        landings[feed] = spark.read.schema(docs.schema).parquet(f"{root}/landing/{feed}")
    half = F.xxhash64("object_name") % 2 == 0
    first = {k: v.select("object_name", F.when(half, F.col("payload")).otherwise(F.substring("payload", 1, 60)).alias("payload")) if k in ("schedules", "operations", "disruptions") else v
             for k, v in landings.items()}
    SJ.load_all(spark, first, f"{root}/layer", LOAD_STAMP)
    SJ.load_all(spark, landings, f"{root}/layer", LOAD_STAMP)
    return SJ.published(spark, f"{root}/layer")


def _iso_day(c="operating_date"):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _iso_ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def loaded_columns() -> dict:
    day, ts = _iso_day, _iso_ts
    return {
        "def_city": ["id", "name", "station_count", "is_active"], "def_station": ["id", "name", "dcit_id"], "def_train_status": ["code", "name"],
        "def_disruption_cause": ["code", "description"],
        "schedule_header": [day(), "schedule_id", "order_id", "train_order_id", "name", "carrier_code", "category_code", "national_number", "is_active"],
        "schedule_details": ["schedule_id", "order_id", "order_number", "dsta_id", "arrival_time", "arrival_day", "departure_time", "departure_day", "departure_platform", "dstty_id"],
        "operation_header": [day(), "schedule_id", "order_id", "train_order_id", "train_status", ts("snapshot_ts")],
        "operation_details": [day(), "order_id", "planned_sequence", "actual_sequence", "dsta_id", ts("actual_arrival"), ts("actual_departure"), "is_confirmed", "is_cancelled",
                              "arrival_delay_min", "departure_delay_min", "dwell_time_sec"],
        "disruption_header": ["id", "disruption_type_code", "message"],
        "disruption_details": [day(), "schedule_id", "order_id", "dsta_id", "dihe_id", "train_order_id", "sequence_number"],
    }


@query("d_load_all")
def d_load_all(spark, sf_dir):
    """Rows and a checksum over all columns of each silver table after two loads, the second onto filled tables."""
    tables, out = _loaded(spark, sf_dir), None
    for name, cols in loaded_columns().items():
        t = tables[name].select(*cols)
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in t.columns])
        one = t.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")).alias("checksum"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- the landing step (A1, A3-A6) -------------------------------------------------------
from perron.plans import landing_job as LJ  # noqa: E402


@query("a6_landing_step")
def a6(spark, sf_dir):
    """Files of the operations tree by day and outcome after three steps, and by day in the landing that they leave.

    The tree has a file for each page, every seventh page cut off. The steps of 07-25, 07-26 and 07-28 list two days each.
    """
    root = scratch(spark, "bucket")
    docs = A.with_file_attributes(P.operations_landing(_fx(spark, sf_dir)))
    text = F.when((F.col("page") - 1) % 7 == 6, F.substring("payload", 1, 100)).otherwise(F.col("payload"))
    # the tasks put their files in place themselves: renaming hundreds of thousands of them one by one would be the driver's work
    tree = docs.select(text.alias("value"), F.col("part_date").alias("date")).write.partitionBy("date").option("maxRecordsPerFile", 1)
    tree = tree.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    for key, value in A.PLAIN_LOCAL_FILES.items():
        tree = tree.option(key, value)
    tree.text(f"{root}/daily/data/operations")
    for day in (25, 26, 28):
        LJ.land(spark, root, "data", "operations", f"{root}/store", dt.date(2001, 7, day), f"2001-07-{day} 06:00:00")
    seen = LJ.outcomes(spark, f"{root}/store").select(F.date_format("part_day", "yyyyMMdd").alias("part_date"), "status")
    left = LJ.landing(spark, f"{root}/store", "operations").select(F.regexp_extract("object_name", A.PART_DATE_RE, 1).alias("part_date"), F.lit("IN LANDING").alias("status"))
    return seen.unionByName(left).groupBy("part_date", "status").agg(F.count("*").alias("n_files"))


# ---- loud narrowing (B8) ----------------------------------------------------------------
from perron.operators import narrow as N  # noqa: E402


@query("b8_narrowing")
def b8(spark, sf_dir):
    """Events as text, some with values that do not fit: each fault with its column and reason, and the typed rows without any."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.col("event_id")
    text = ev.select("event_id", F.when(k % 13 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
                     F.concat(F.col("user_id").cast("string"), F.when(k % 17 == 0, "x").otherwise("")).alias("user_id"), "event_type")
    good, bad = N.write_narrowed(text, {"ts": "timestamp", "user_id": "bigint", "event_type": 6}, scratch(spark, "narrow"), ["event_id"], quarantine=True)
    good = good.select("event_id", F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("reason"),
                       F.concat_ws("|", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id") + 0, "event_type").alias("value"))
    return bad.unionByName(good)
