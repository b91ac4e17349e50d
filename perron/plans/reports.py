"""Report views over gold facts (H4-H13) and their trace views (H1-H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perron.functions.ratio import avg2, pct
from perron.plans.gold_dims import d_station
from perron.plans.gold_facts import TYPE_KEY, train_types
from perron.plans.silver_model import Silver

ROUTE = ["from_station_id", "to_station_id"]


def _memo(s: Silver, key: str, build) -> DataFrame:
    if key not in s.extra:
        s.extra[key] = build()
    return s.extra[key]


def _station_names(s: Silver) -> DataFrame:
    return _memo(s, "station_names", lambda:
                 d_station(s.def_station, s.def_city).select("id", "station_name"))


def _type_names(s: Silver) -> DataFrame:
    # train_types() is already size-checked and hinted
    return train_types(s).select(
        "category_code", "carrier_code", F.date_format("valid_from", "yyyy-MM-dd").alias("type_valid_from"),
        "category_name", "carrier_name")


def _with_route_name(df: DataFrame, s: Silver) -> DataFrame:
    st = _station_names(s)
    fs = st.select(F.col("id").alias("from_station_id"), F.col("station_name").alias("_fs"))
    ts = st.select(F.col("id").alias("to_station_id"), F.col("station_name").alias("_ts"))
    return (df.join(fs, "from_station_id", "inner").join(ts, "to_station_id", "inner")
            .withColumn("route_name", F.concat("_fs", F.lit(" -> "), "_ts")).drop("_fs", "_ts"))


def punctuality_monthly(s: Silver, run_monthly: DataFrame) -> DataFrame:
    """H4 v_rep_punctuality_monthly: month x route x train type."""
    m = run_monthly
    dc = F.col("delayed_count")
    a = m.groupBy("month", *ROUTE, *TYPE_KEY).agg(
        F.sum("runs_count").alias("runs_total"),
        F.sum(F.when(dc.isNotNull(), F.col("runs_count"))).alias("runs_completed"),
        F.sum(F.when(dc.isNull(), F.col("runs_count"))).alias("cancelled_count"),
        F.sum(F.when(F.col("status_code") == "Q", F.col("runs_count"))).alias("shortened_count"),
        F.sum(dc).alias("delayed_count"),
        F.sum("sum_terminal_delay_min").alias("sum_terminal_delay_min"),
        F.sum("sum_delayed_delay_min").alias("sum_delayed_delay_min"),
        F.max("max_terminal_delay_min").alias("max_terminal_delay_min"),
        F.sum("travel_runs_count").alias("travel_runs_count"),
        F.sum("sum_planned_travel_min").alias("sum_planned_travel_min"),
        F.sum("sum_actual_travel_min").alias("sum_actual_travel_min"),
        F.min("min_actual_travel_min").alias("min_actual_travel_min"),
        F.max("max_actual_travel_min").alias("max_actual_travel_min"),
    )
    a = _with_route_name(a, s).join(_type_names(s), TYPE_KEY, "inner")
    c = F.col
    return a.select(
        "month", "route_name", "category_name", "carrier_name", *ROUTE, *TYPE_KEY,
        "runs_total", "runs_completed", "cancelled_count", "shortened_count", "delayed_count",
        (c("runs_completed") - c("delayed_count")).alias("on_time_count"),
        "sum_terminal_delay_min", "sum_delayed_delay_min", "max_terminal_delay_min",
        "travel_runs_count", "sum_planned_travel_min", "sum_actual_travel_min",
        "min_actual_travel_min", "max_actual_travel_min",
        pct(c("runs_completed") - c("delayed_count"), "runs_completed").alias("on_time_pct"),
        pct("delayed_count", "runs_completed").alias("delayed_pct"),
        pct("cancelled_count", "runs_total").alias("cancelled_pct"),
        avg2("sum_terminal_delay_min", "runs_completed").alias("avg_terminal_delay_min"),
        avg2("sum_delayed_delay_min", "delayed_count").alias("avg_delayed_delay_min"),
        avg2("sum_planned_travel_min", "travel_runs_count").alias("avg_planned_travel_min"),
        avg2("sum_actual_travel_min", "travel_runs_count").alias("avg_actual_travel_min"),
    )


def punctuality_by_daytype_monthly(s: Silver, run_monthly: DataFrame) -> DataFrame:
    """H5 v_rep_punctuality_by_daytype_monthly (H4 split by day type, no shortened count)."""
    dc = F.col("delayed_count")
    a = run_monthly.groupBy("month", *ROUTE, *TYPE_KEY, "day_type").agg(
        F.sum("runs_count").alias("runs_total"),
        F.sum(F.when(dc.isNotNull(), F.col("runs_count"))).alias("runs_completed"),
        F.sum(F.when(dc.isNull(), F.col("runs_count"))).alias("cancelled_count"),
        F.sum(dc).alias("delayed_count"),
        F.sum("sum_terminal_delay_min").alias("sum_terminal_delay_min"),
        F.sum("sum_delayed_delay_min").alias("sum_delayed_delay_min"),
        F.max("max_terminal_delay_min").alias("max_terminal_delay_min"),
        F.sum("travel_runs_count").alias("travel_runs_count"),
        F.sum("sum_planned_travel_min").alias("sum_planned_travel_min"),
        F.sum("sum_actual_travel_min").alias("sum_actual_travel_min"),
        F.min("min_actual_travel_min").alias("min_actual_travel_min"),
        F.max("max_actual_travel_min").alias("max_actual_travel_min"),
    )
    a = _with_route_name(a, s).join(_type_names(s), TYPE_KEY, "inner")
    c = F.col
    return a.select(
        "month", "day_type", "route_name", "category_name", "carrier_name", *ROUTE, *TYPE_KEY,
        "runs_total", "runs_completed", "cancelled_count", "delayed_count",
        (c("runs_completed") - c("delayed_count")).alias("on_time_count"),
        "sum_terminal_delay_min", "sum_delayed_delay_min", "max_terminal_delay_min",
        "travel_runs_count", "sum_planned_travel_min", "sum_actual_travel_min",
        "min_actual_travel_min", "max_actual_travel_min",
        pct(c("runs_completed") - c("delayed_count"), "runs_completed").alias("on_time_pct"),
        pct("delayed_count", "runs_completed").alias("delayed_pct"),
        pct("cancelled_count", "runs_total").alias("cancelled_pct"),
        avg2("sum_terminal_delay_min", "runs_completed").alias("avg_terminal_delay_min"),
        avg2("sum_delayed_delay_min", "delayed_count").alias("avg_delayed_delay_min"),
        avg2("sum_planned_travel_min", "travel_runs_count").alias("avg_planned_travel_min"),
        avg2("sum_actual_travel_min", "travel_runs_count").alias("avg_actual_travel_min"),
    )


def status_share_monthly(s: Silver, run_monthly: DataFrame) -> DataFrame:
    """H6 v_rep_status_share_monthly: share of each status inside month x route x type.

    The window total is partitioned by the whole (month, route, type) key,
    so each window partition is one small report cell group.
    """
    a = run_monthly.groupBy("month", *ROUTE, *TYPE_KEY, "status_code").agg(
        F.sum("runs_count").alias("runs_count"),
        F.sum("delayed_count").alias("delayed_count"),
        F.sum("sum_terminal_delay_min").alias("sum_terminal_delay_min"),
        F.sum("sum_delayed_delay_min").alias("sum_delayed_delay_min"),
        F.max("max_terminal_delay_min").alias("max_terminal_delay_min"),
    )
    total = F.sum("runs_count").over(Window.partitionBy("month", *ROUTE, *TYPE_KEY))
    st = s.def_train_status.select(F.col("code").alias("status_code"),
                                    F.col("name").alias("status_name"))
    a = (_with_route_name(a, s).join(_type_names(s), TYPE_KEY, "inner").join(st, "status_code", "inner"))
    return a.select(
        "month", "route_name", "category_name", "carrier_name", "status_name", *ROUTE, *TYPE_KEY,
        "status_code", "runs_count", "delayed_count", "sum_terminal_delay_min", "sum_delayed_delay_min",
        "max_terminal_delay_min", total.alias("runs_total_month"),
        pct(F.col("runs_count"), total).alias("share_pct"),
    )


def _hour_labels(s: Silver) -> DataFrame:
    from perron.plans.gold_dims import d_hour
    return F.broadcast(d_hour(s.spark).select(F.col("id").alias("hour_id"), "hour_label"))  # 24 rows


def stop_hourly_monthly(s: Silver, stop_monthly: DataFrame) -> DataFrame:
    """H7 v_rep_stop_hourly_monthly: arrivals by station and planned hour."""
    a = stop_monthly.groupBy("month", *ROUTE, "station_id", "hour_id", *TYPE_KEY).agg(
        *[F.sum(c).alias(c) for c in ["arrivals_count", "arrivals_on_time", "arrivals_delayed",
                                      "sum_arrival_delay_min", "sum_delayed_delay_min"]],
        F.max("max_arrival_delay_min").alias("max_arrival_delay_min"),
        F.sum("cancelled_count").alias("cancelled_count"),
    )
    ss = _station_names(s).select(F.col("id").alias("station_id"), "station_name")
    a = (_with_route_name(a, s).join(ss, "station_id", "inner").join(_hour_labels(s), "hour_id", "inner")
         .join(_type_names(s), TYPE_KEY, "inner"))
    c = F.col
    return a.select(
        "month", "route_name", "station_name", "hour_label", "category_name", "carrier_name",
        *ROUTE, "station_id", "hour_id", *TYPE_KEY,
        "arrivals_count", "arrivals_on_time", "arrivals_delayed", "sum_arrival_delay_min",
        "sum_delayed_delay_min", "max_arrival_delay_min", "cancelled_count",
        pct("arrivals_on_time", "arrivals_count").alias("on_time_pct"),
        pct("arrivals_delayed", "arrivals_count").alias("delayed_pct"),
        avg2("sum_arrival_delay_min", "arrivals_count").alias("avg_arrival_delay_min"),
        avg2("sum_delayed_delay_min", "arrivals_delayed").alias("avg_delayed_delay_min"),
        pct("cancelled_count", c("arrivals_count") + c("cancelled_count")).alias("cancelled_pct"),
    )


def _cause_names(s: Silver) -> DataFrame:
    return _memo(s, "cause_names", lambda: s.def_disruption_cause.select(
        F.col("code").alias("cause_code"), F.col("description").alias("cause_name")))


def disruption_causes_monthly(s: Silver, dis_monthly: DataFrame) -> DataFrame:
    """H8 v_rep_disruption_causes_monthly: cause share inside month x route x station."""
    a = dis_monthly.groupBy("month", *ROUTE, "station_id", *TYPE_KEY, "cause_code").agg(
        F.sum("occurrences_count").alias("occurrences_count"))
    total = F.sum("occurrences_count").over(Window.partitionBy("month", *ROUTE, "station_id"))
    ss = _station_names(s).select(F.col("id").alias("station_id"), "station_name")
    a = (_with_route_name(a, s).join(ss, "station_id", "inner").join(_type_names(s), TYPE_KEY, "inner")
         .join(_cause_names(s), "cause_code", "inner"))
    return a.select(
        "month", "route_name", "station_name", "category_name", "carrier_name", "cause_name",
        *ROUTE, "station_id", *TYPE_KEY, "cause_code", "occurrences_count",
        total.alias("occurrences_total"), pct(F.col("occurrences_count"), total).alias("share_pct"),
    )


def run_route(s: Silver) -> DataFrame:
    """H9 v_rep_run_route: delay profile along each executed run.

    The relation label (first -> last station by planned sequence) comes
    from one grouped pass per run joined back, not from a full-frame window
    (ties on the planned sequence are broken by the actual sequence).
    """
    oh = s.operation_header.select(F.col("id").alias("ophe_id"), "operating_date", "schedule_id", "order_id",
                                   "train_order_id")
    od = s.operation_details
    ds = s.def_station.select(F.col("id").alias("dsta_id"), F.col("name").alias("station_name"))
    sh = s.schedule_header.select("operating_date", "schedule_id", "order_id", "train_order_id", "category_code",
                                  "carrier_code", "national_number", F.col("name").alias("train_name"))
    from perron.functions.ordered import first_row, last_row
    rel = (oh.select("ophe_id", "operating_date").join(od, ["ophe_id", "operating_date"], "inner").join(ds, "dsta_id", "inner")
           .groupBy("ophe_id").agg(
        first_row(["planned_sequence", "actual_sequence"], ["station_name"]).alias("f"),
        last_row(["planned_sequence", "actual_sequence"], ["station_name"]).alias("l"),
    ).select("ophe_id", F.concat(F.col("f.station_name"), F.lit(" -> "), F.col("l.station_name")).alias("relation")))
    sd = s.schedule_details.select("schedule_id", "order_id", F.col("order_number").alias("planned_sequence"),
                                   F.col("arrival_time").alias("planned_arrival_time"),
                                   F.col("departure_time").alias("planned_departure_time"))
    # what belongs to a run is looked up once a run, then joined to its stops
    runs = oh.join(rel, "ophe_id", "inner").join(sh, ["operating_date", "schedule_id", "order_id", "train_order_id"], "left")
    x = (runs.join(od, ["ophe_id", "operating_date"], "inner").join(ds, "dsta_id", "inner")
         .join(sd, ["schedule_id", "order_id", "planned_sequence"], "left"))
    ok = F.col("is_confirmed") & ~F.col("is_cancelled")
    ts = "yyyy-MM-dd HH:mm:ss"
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "ophe_id", "schedule_id",
        "order_id", "train_order_id", "category_code", "carrier_code", "national_number", "train_name",
        "relation", F.col("planned_sequence").alias("stop_seq"), "actual_sequence",
        F.col("dsta_id").alias("station_id"), "station_name", "planned_arrival_time", "planned_departure_time",
        F.date_format("actual_arrival", ts).alias("actual_arrival"),
        F.date_format("actual_departure", ts).alias("actual_departure"),
        "is_confirmed", "is_cancelled", "arrival_delay_min", "departure_delay_min",
        F.when(ok, F.coalesce("arrival_delay_min", F.lit(0))).alias("eff_arrival_delay_min"),
        F.when(ok, F.coalesce("departure_delay_min", F.lit(0))).alias("eff_departure_delay_min"),
    )


def _month_txt(c: str = "month"):
    m = F.col(c).cast("string")
    return F.concat(F.substring(m, 1, 4), F.lit("-"), F.substring(m, 5, 2))


def station_hourly_monthly(s: Silver, stop_monthly: DataFrame, dep_monthly: DataFrame,
                           station_id: int) -> DataFrame:
    """H10 station by month, direction (P arrivals / O departures) and hour."""
    p = stop_monthly.filter(F.col("station_id") == station_id).select(
        "month", F.lit("P").alias("kierunek"), "hour_id", F.col("arrivals_count").alias("n"),
        F.col("arrivals_on_time").alias("n_ok"), F.col("arrivals_delayed").alias("n_late"),
        F.col("cancelled_count").alias("n_odw"), F.col("sum_arrival_delay_min").alias("sum_op"))
    o = dep_monthly.filter(F.col("station_id") == station_id).select(
        "month", F.lit("O").alias("kierunek"), "hour_id", F.col("departures_count").alias("n"),
        F.col("departures_on_time").alias("n_ok"), F.col("departures_delayed").alias("n_late"),
        F.col("cancelled_count").alias("n_odw"), F.col("sum_departure_delay_min").alias("sum_op"))
    z = p.unionByName(o).join(_hour_labels(s), "hour_id", "inner")
    return z.groupBy("month", "kierunek", "hour_id", "hour_label").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ["n", "n_ok", "n_late", "n_odw", "sum_op"]]
    ).select("month", _month_txt().alias("month_txt"), "kierunek", "hour_id", "hour_label",
             "n", "n_ok", "n_late", "n_odw", "sum_op")


def station_weekday_monthly(stop_daily: DataFrame, dep_daily: DataFrame, station_id: int) -> DataFrame:
    """H11 station by month, direction and ISO weekday, with the number of distinct days."""
    p = stop_daily.filter(F.col("station_id") == station_id).select(
        "date_id", F.lit("P").alias("kierunek"), F.col("arrivals_count").alias("n"),
        F.col("arrivals_on_time").alias("n_ok"), F.col("arrivals_delayed").alias("n_late"),
        F.col("cancelled_count").alias("n_odw"), F.col("sum_arrival_delay_min").alias("sum_op"))
    o = dep_daily.filter(F.col("station_id") == station_id).select(
        "date_id", F.lit("O").alias("kierunek"), F.col("departures_count").alias("n"),
        F.col("departures_on_time").alias("n_ok"), F.col("departures_delayed").alias("n_late"),
        F.col("cancelled_count").alias("n_odw"), F.col("sum_departure_delay_min").alias("sum_op"))
    d = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    z = p.unionByName(o).select("*", (F.year(d) * 100 + F.month(d)).cast("bigint").alias("month"),
                                F.date_format(d, "yyyy-MM").alias("month_txt"),
                                (F.weekday(d) + 1).alias("dzien_tyg"))
    return z.groupBy("month", "month_txt", "kierunek", "dzien_tyg").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ["n", "n_ok", "n_late", "n_odw", "sum_op"]],
        F.count_distinct("date_id").cast("bigint").alias("liczba_dni"))


def station_directions_monthly(s: Silver, stop_monthly: DataFrame, dep_monthly: DataFrame,
                               station_id: int) -> DataFrame:
    """H12 by far-end station: route origin for arrivals, route destination for departures."""
    p = stop_monthly.filter(F.col("station_id") == station_id).select(
        "month", F.lit("P").alias("kierunek"), F.col("from_station_id").alias("stacja_id"),
        F.col("arrivals_count").alias("n"), F.col("arrivals_on_time").alias("n_ok"),
        F.col("cancelled_count").alias("n_odw"), F.col("sum_arrival_delay_min").alias("sum_op"))
    o = dep_monthly.filter(F.col("station_id") == station_id).select(
        "month", F.lit("O").alias("kierunek"), F.col("to_station_id").alias("stacja_id"),
        F.col("departures_count").alias("n"), F.col("departures_on_time").alias("n_ok"),
        F.col("cancelled_count").alias("n_odw"), F.col("sum_departure_delay_min").alias("sum_op"))
    st = _station_names(s).select(F.col("id").alias("stacja_id"), F.col("station_name").alias("stacja"))
    z = p.unionByName(o).join(st, "stacja_id", "inner")
    return z.groupBy("month", "kierunek", "stacja_id", "stacja").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ["n", "n_ok", "n_odw", "sum_op"]]
    ).select("month", _month_txt().alias("month_txt"), "kierunek", "stacja_id", "stacja",
             "n", "n_ok", "n_odw", "sum_op")


# Fixed value: the section template inside cause descriptions and its replacement.
SECTION_TEMPLATE = r"Na odcinku od stacji \{[^}]*\} do stacji \{[^}]*\}"
SECTION_TEXT = "Na części trasy"


def station_disruptions_monthly(s: Silver, dis_daily: DataFrame, station_id: int) -> DataFrame:
    """H13 station disruptions by month, weekday, day type and cause (template text cleaned)."""
    d = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    x = dis_daily.filter(F.col("station_id") == station_id).join(_cause_names(s), "cause_code", "inner")
    x = x.select(
        (F.year(d) * 100 + F.month(d)).cast("bigint").alias("month"), F.date_format(d, "yyyy-MM").alias("month_txt"),
        (F.weekday(d) + 1).alias("dzien_tyg"), F.when(F.weekday(d) >= 5, "WE").otherwise("WD").alias("day_type"),
        "cause_code", F.regexp_replace("cause_name", SECTION_TEMPLATE, SECTION_TEXT).alias("przyczyna"),
        "occurrences_count", "runs_count", "runs_total_count")
    return x.groupBy("month", "month_txt", "dzien_tyg", "day_type", "cause_code", "przyczyna").agg(
        F.sum("occurrences_count").cast("bigint").alias("wystapienia"),
        F.sum("runs_count").cast("bigint").alias("kursy"),
        F.sum("runs_total_count").cast("bigint").alias("kursy_razem"))
