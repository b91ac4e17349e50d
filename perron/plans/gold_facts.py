"""Gold facts G1-G17.

Shape of every daily loader:
  runs in window (G1: header join timetable header, both sides pruned on the
  date) -> plan ends per plan (G2/G3/G7: one grouped pass) -> executed-stop
  spans per run (G5/G6: one grouped pass over confirmed stops) -> version of
  the train type at the run date (G4: Spark broadcasts the version table while it is small) -> grouped
  measures. Monthly facts (G14-G17) roll the daily rows up by month and day
  type; the calendar attributes are computed from the date key, so no row is
  lost to a calendar that does not cover the data (finding 11).

Output keys are natural: ``date_id`` (YYYYMMDD), ``from_station_id``/
``to_station_id`` (route), ``category_code``/``carrier_code``/
``type_valid_from`` (train type version), ``status_code``, ``station_id``,
``hour_id``, ``cause_code``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.functions.clock import clock_minutes, date_key
from perron.functions.ordered import first_row, last_row
from perron.operators.joins import OPEN_END, version_at_date
from perron.plans.gold_dims import d_train_type, plan_ends
from perron.plans.silver_model import Silver

def _memo(fn):
    """Memoize a ``(Silver, Window_) -> DataFrame`` builder on the silver bundle.

    DataFrames are immutable plans; sharing one object per (builder, window)
    saves the driver from re-analysing the same plan and lets Catalyst reuse
    exchanges when several outputs of one job share a fact.
    """
    def wrapper(s, w):
        key = (fn.__name__, w)
        if key not in s.extra:
            s.extra[key] = fn(s, w)
        return s.extra[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


ON_TIME_MAX = 5      # on time: delay <= 5 min
DELAYED_MIN = 6      # delayed: delay >= 6 min

TYPE_KEY = ["category_code", "carrier_code", "type_valid_from"]


@dataclass(frozen=True)
class Window_:
    date_from: dt.date
    date_to: dt.date

    @classmethod
    def days_back(cls, as_of: dt.date, days: int) -> Window_:
        return cls(as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1))

    def between(self, col: str) -> Column:
        return F.col(col).between(F.lit(self.date_from), F.lit(self.date_to))


@_memo
def runs_in_window(s: Silver, w: Window_) -> DataFrame:
    """G1: executed runs of the window with their timetable attributes."""
    oh = s.operation_header.filter(w.between("operating_date")).select(
        F.col("id").alias("ophe_id"), "operating_date", "schedule_id", "order_id", "train_order_id",
        "train_status")
    sh = s.schedule_header.filter(w.between("operating_date")).select(
        "operating_date", "schedule_id", "order_id", "train_order_id", "category_code", "carrier_code")
    return oh.join(sh, ["operating_date", "schedule_id", "order_id", "train_order_id"], "inner")


def ends_for(s: Silver, keys: DataFrame) -> DataFrame:
    """Plan ends only for plans referenced by ``keys`` (semi join)."""
    k = keys.select("schedule_id", "order_id").distinct()
    if "plan_ends" in s.extra:
        return s.extra["plan_ends"].join(k, ["schedule_id", "order_id"], "left_semi")
    sd = s.schedule_details.join(k, ["schedule_id", "order_id"], "left_semi")
    return plan_ends(sd)


def _stops_in_window(s: Silver, w: Window_) -> DataFrame:
    """Executed stops of the window's runs.

    Stops carry their run's operating date, so the window is a filter on the
    (partition) column and the scan reads only the window's days instead of
    the whole history.
    """
    return s.operation_details.filter(w.between("operating_date"))


def journeys(operation_details: DataFrame) -> DataFrame:
    """A run's first and last confirmed stop as ``left`` (place, at) and ``came`` (place, at, late), one grouped pass."""
    stops = operation_details.filter(F.col("is_confirmed")).groupBy("ophe_id").agg(
        first_row(["actual_sequence"], ["planned_sequence", "actual_departure"]).alias("f"),
        last_row(["actual_sequence"], ["planned_sequence", "actual_arrival", "arrival_delay_min"]).alias("l"))
    return stops.select(
        "ophe_id", F.struct(F.col("f.planned_sequence").alias("place"), F.unix_timestamp("f.actual_departure").alias("at")).alias("left"),
        F.struct(F.col("l.planned_sequence").alias("place"), F.unix_timestamp("l.actual_arrival").alias("at"),
                 F.coalesce("l.arrival_delay_min", F.lit(0)).alias("late")).alias("came"))


def lateness(operation_details: DataFrame) -> DataFrame:
    """Minutes that each run with a confirmed stop was late at the last one."""
    return journeys(operation_details).select("ophe_id", F.col("came.late").alias("terminal_delay"))


def train_types(s: Silver) -> DataFrame:
    """d_train_type for this silver snapshot, built once."""
    if "d_train_type" not in s.extra:
        tt = d_train_type(s.def_commercial_category, s.def_carrier, s.schedule_header)
        root = getattr(s, "_root", None)
        if root is not None:
            # the gold dimension is a stored table: facts read a small Parquet
            # table instead of re-deriving it from the timetable in every plan
            tt.write.mode("overwrite").parquet(f"{root}/d_train_type")
            tt = s.spark.read.parquet(f"{root}/d_train_type")
        s.extra["d_train_type"] = tt
    return s.extra["d_train_type"]


def with_type_version(df: DataFrame, s: Silver, date_col: str = "operating_date") -> DataFrame:
    """Version of (category, carrier) valid at the date, else the open version."""
    tt = train_types(s).select("category_code", "carrier_code", "valid_from", "valid_to")
    out = version_at_date(df, tt, ["category_code", "carrier_code"], date_col, out_prefix="tt_")
    return out.withColumn("type_valid_from", F.date_format("tt_valid_from", "yyyy-MM-dd")).drop(
        "tt_valid_from", "tt_valid_to")


@_memo
def typed_runs(s: Silver, w: Window_) -> DataFrame:
    """The window's runs with the ends of their plan and the type version of their day; a run without either makes no row."""
    r = runs_in_window(s, w)
    return with_type_version(r.join(ends_for(s, r), ["schedule_id", "order_id"]), s).filter(F.col("type_valid_from").isNotNull())


@contextmanager
def stored(s: Silver, w: Window_, store: Callable[[str, DataFrame], DataFrame]) -> Iterator[None]:
    """While it lasts, the window's facts share what ``store`` has written: plan ends, runs with what belongs to them, stop lines."""
    def mine() -> list:
        return [k for k in s.extra if k == "plan_ends" or isinstance(k, tuple) and k[1:] == (w,)]

    before = {k: s.extra.pop(k) for k in mine()}
    try:
        s.extra["plan_ends"] = store("plan_ends", plan_ends(s.schedule_details))
        s.extra["typed_runs", w] = store("typed_runs", typed_runs(s, w))
        s.extra["stop_lines", w] = store("stop_lines", stop_lines(s, w))
        yield
    finally:
        for k in mine():
            del s.extra[k]
        s.extra.update(before)


def _statuses(s: Silver) -> DataFrame:
    if "statuses" not in s.extra:
        s.extra["statuses"] = s.def_train_status.select(F.col("code").alias("train_status"))
    return s.extra["statuses"]


def _planned_minute(time: str, day: str) -> Column:
    """Minutes from the run day's midnight to a planned clock; null without one."""
    return F.coalesce(day, F.lit(0)) * 1440 + clock_minutes(time)


def _moment(stop: str, edge: str, minute: Column) -> Column:
    """Seconds of an end of the journey: measured if its stop is the plan's own end, else as planned (``minute``)."""
    measured = F.when(F.col(f"{stop}.place") == F.col(edge), F.col(f"{stop}.at"))
    return F.coalesce(measured, F.unix_date("operating_date").cast("bigint") * 86400 + minute * 60)


@_memo
def run_resolved(s: Silver, w: Window_) -> DataFrame:
    """Per run: keys of the fact cell, terminal delay and travel minutes.

    A run without a route, a type version or a known status makes no row (G9); one without confirmed stops has no delay.
    """
    runs = typed_runs(s, w).join(_statuses(s), "train_status", "left_semi")
    leaves, comes = _planned_minute("dep_time", "dep_day"), _planned_minute("arr_time", "arr_day")
    x = (runs.join(journeys(_stops_in_window(s, w)), "ophe_id", "left")
         .withColumn("planned_travel_min", (comes - leaves).cast("bigint")))
    went = _moment("came", "max_on", comes + F.col("came.late")) - _moment("left", "min_on", leaves)
    complete = (F.col("train_status") == "C") & F.col("came").isNotNull() & F.col("planned_travel_min").isNotNull()
    return x.select(
        "ophe_id", "operating_date", "schedule_id", "order_id", date_key("operating_date").alias("date_id"), "from_station_id", "to_station_id", *TYPE_KEY,
        F.col("train_status").alias("status_code"), F.col("came.late").alias("terminal_delay"), "planned_travel_min",
        F.when(complete, F.round(went / 60.0).cast("bigint")).alias("actual_travel_min"))


RUN_CELL = ["date_id", "from_station_id", "to_station_id", *TYPE_KEY, "status_code"]


@_memo
def run_daily(s: Silver, w: Window_) -> DataFrame:
    """G10 f_train_run_daily."""
    td = F.col("terminal_delay")
    at = F.col("actual_travel_min")
    has_td = F.count(td) > 0
    return run_resolved(s, w).groupBy(*RUN_CELL).agg(
        F.count(F.lit(1)).alias("runs_count"),
        F.when(has_td, F.sum(F.when(td >= DELAYED_MIN, 1).otherwise(0))).cast("bigint").alias("delayed_count"),
        F.sum(td).cast("bigint").alias("sum_terminal_delay_min"),
        F.when(has_td, F.coalesce(F.sum(F.when(td >= DELAYED_MIN, td)), F.lit(0))).cast("bigint")
        .alias("sum_delayed_delay_min"),
        F.max(td).cast("bigint").alias("max_terminal_delay_min"),
        F.when(F.count(at) > 0, F.count(at)).cast("bigint").alias("travel_runs_count"),
        F.sum(F.when(at.isNotNull(), F.col("planned_travel_min"))).cast("bigint").alias("sum_planned_travel_min"),
        F.sum(at).cast("bigint").alias("sum_actual_travel_min"),
        F.min(at).alias("min_actual_travel_min"),
        F.max(at).alias("max_actual_travel_min"),
    )


@_memo
def stop_lines(s: Silver, w: Window_) -> DataFrame:
    """Executed stops of window runs with their plan row, for G11 and G12."""
    # what belongs to a run is looked up once a run, then joined to its stops
    runs = typed_runs(s, w).select("ophe_id", "operating_date", "schedule_id", "order_id", "from_station_id", "to_station_id", *TYPE_KEY)
    od = _stops_in_window(s, w).select("ophe_id", "planned_sequence", "dsta_id", "actual_arrival", "is_confirmed", "is_cancelled",
                                       "arrival_delay_min", "departure_delay_min").join(runs, "ophe_id")
    sd = s.schedule_details.select("schedule_id", "order_id", F.col("order_number").alias("planned_sequence"), "arrival_time", "departure_time")
    return od.join(sd, ["schedule_id", "order_id", "planned_sequence"], "inner").drop("ophe_id", "schedule_id", "order_id", "planned_sequence")


def _stop_rows(s: Silver, w: Window_, kind: str) -> DataFrame:
    """The stop lines that have a plan time (G11 arrivals / G12 departures)."""
    t_col = "arrival_time" if kind == "arr" else "departure_time"
    x = stop_lines(s, w).filter(F.col(t_col).isNotNull())
    ok = F.col("is_confirmed") & ~F.col("is_cancelled")
    if kind == "arr":
        ok = ok & F.col("actual_arrival").isNotNull()
        delay = F.coalesce("arrival_delay_min", F.lit(0))
    else:
        delay = F.coalesce("departure_delay_min", F.lit(0))
    return x.select(
        date_key("operating_date").alias("date_id"), "from_station_id", "to_station_id", *TYPE_KEY,
        F.col("dsta_id").alias("station_id"), F.substring(t_col, 1, 2).cast("int").alias("hour_id"),
        F.when(ok, 1).otherwise(0).alias("is_counted"),
        F.when(ok, delay).alias("eff_delay"),
        F.when(F.col("is_cancelled"), 1).otherwise(0).alias("is_cancelled"),
    )


STOP_CELL = ["date_id", "from_station_id", "to_station_id", *TYPE_KEY, "station_id", "hour_id"]


def _stop_measures(prefix: str, singular: str) -> list[Column]:
    n = F.col("is_counted")
    d = F.col("eff_delay")
    return [
        F.sum(n).cast("bigint").alias(f"{prefix}_count"),
        F.sum(F.when((n == 1) & (d <= ON_TIME_MAX), 1).otherwise(0)).cast("bigint").alias(f"{prefix}_on_time"),
        F.sum(F.when((n == 1) & (d >= DELAYED_MIN), 1).otherwise(0)).cast("bigint").alias(f"{prefix}_delayed"),
        F.sum(d).cast("bigint").alias(f"sum_{singular}_delay_min"),
        F.when(F.sum(n) == 0, F.lit(None)).otherwise(F.coalesce(F.sum(F.when(d >= DELAYED_MIN, d)), F.lit(0)))
        .cast("bigint").alias("sum_delayed_delay_min"),
        F.max(d).cast("bigint").alias(f"max_{singular}_delay_min"),
        F.sum("is_cancelled").cast("bigint").alias("cancelled_count"),
    ]


@_memo
def stop_daily(s: Silver, w: Window_) -> DataFrame:
    """G11 f_train_stop_daily: arrivals per station and planned arrival hour (origin skipped)."""
    return _stop_rows(s, w, "arr").groupBy(*STOP_CELL).agg(*_stop_measures("arrivals", "arrival"))


@_memo
def dep_daily(s: Silver, w: Window_) -> DataFrame:
    """G12 f_train_dep_daily: departures per station and planned departure hour (terminal skipped)."""
    return _stop_rows(s, w, "dep").groupBy(*STOP_CELL).agg(*_stop_measures("departures", "departure"))


def header_causes(s: Silver) -> DataFrame:
    """The cause of each disruption header that has one, and where it was found: its type (TYPE), else its message (MESSAGE)."""
    named = s.disruption_header.select(F.col("id").alias("dihe_id"), F.explode(F.array(
        F.struct(F.lit(1).alias("rank"), F.col("disruption_type_code").alias("code")), F.struct(F.lit(2).alias("rank"), F.col("message").alias("code")))).alias("c"))
    known = named.select("dihe_id", "c.rank", "c.code").join(s.def_disruption_cause.select("code"), "code")
    best = known.groupBy("dihe_id").agg(F.min(F.struct("rank", "code")).alias("best"))
    return best.select("dihe_id", F.col("best.code").alias("cause_code"), F.when(F.col("best.rank") == 1, "TYPE").otherwise("MESSAGE").alias("cause_source"))


@_memo
def disruption_resolved(s: Silver, w: Window_) -> DataFrame:
    """Affected stops of the window that have all that a cell needs: route, type version, planned hour and cause (G13 rows)."""
    stops = s.disruption_details.filter(w.between("operating_date"))
    plan = s.schedule_details.select("schedule_id", "order_id", F.col("order_number").alias("sequence_number"),
                                     F.substring(F.coalesce("arrival_time", "departure_time"), 1, 2).cast("int").alias("hour_id")).filter(F.col("hour_id").isNotNull())
    dated = s.schedule_header.filter(w.between("operating_date")).select("operating_date", "schedule_id", "order_id", "train_order_id", "category_code", "carrier_code")
    runs = with_type_version(dated, s).filter(F.col("type_valid_from").isNotNull())
    x = (stops.join(header_causes(s), "dihe_id").join(plan, ["schedule_id", "order_id", "sequence_number"])
         .join(runs, ["operating_date", "schedule_id", "order_id", "train_order_id"])
         .join(ends_for(s, stops).select("schedule_id", "order_id", "from_station_id", "to_station_id"), ["schedule_id", "order_id"]))
    return x.select(date_key("operating_date").alias("date_id"), "schedule_id", "order_id", "from_station_id", "to_station_id",
                    F.col("dsta_id").alias("station_id"), *TYPE_KEY, "hour_id", "cause_code")


DIS_CELL = ["date_id", "from_station_id", "to_station_id", "station_id", *TYPE_KEY, "hour_id", "cause_code"]


@_memo
def disruption_daily(s: Silver, w: Window_) -> DataFrame:
    """G13 f_train_disruption_daily.

    ``runs_total_count`` attributes each run to the lowest cause it has at that station and day. A run's stops of a cell
    are added up first; the lowest cause is a window over a run's few cells of a station and day, and the cells then only
    add up numbers: one pass, no distinct count, no join with itself.
    """
    run = ["schedule_id", "order_id"]
    visits = disruption_resolved(s, w).groupBy(*DIS_CELL, *run).agg(F.count(F.lit(1)).alias("times"))
    least = F.min("cause_code").over(Window.partitionBy("date_id", "station_id", *run))
    visits = visits.withColumn("is_least", (F.col("cause_code") == least).cast("bigint"))
    return visits.groupBy(*DIS_CELL).agg(F.sum("times").alias("occurrences_count"), F.count(F.lit(1)).alias("runs_count"), F.sum("is_least").alias("runs_total_count"))


# ---- monthly roll-ups (G14-G17) -------------------------------------------

def month_window(w: Window_) -> Window_:
    """Widen the daily window to whole months."""
    start = w.date_from.replace(day=1)
    nxt = (w.date_to.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return Window_(start, nxt - dt.timedelta(days=1))


def _month_keys() -> list[Column]:
    d = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    return [(F.year(d) * 100 + F.month(d)).cast("bigint").alias("month"),
            F.when(F.weekday(d) >= 5, "WE").otherwise("WD").alias("day_type")]


def rollup_monthly(daily: DataFrame, keys: list[str], sums: list[str], mins: list[str] = (),
                   maxs: list[str] = ()) -> DataFrame:
    x = daily.select(*_month_keys(), *keys, *sums, *mins, *maxs)
    aggs = ([F.sum(c).cast("bigint").alias(c) for c in sums] + [F.min(c).alias(c) for c in mins]
            + [F.max(c).alias(c) for c in maxs])
    return x.groupBy("month", *keys, "day_type").agg(*aggs)


def run_monthly(daily: DataFrame) -> DataFrame:
    """G14 f_train_run_monthly."""
    keys = [k for k in RUN_CELL if k != "date_id"]
    return rollup_monthly(daily, keys,
                          ["runs_count", "delayed_count", "sum_terminal_delay_min", "sum_delayed_delay_min",
                           "travel_runs_count", "sum_planned_travel_min", "sum_actual_travel_min"],
                          ["min_actual_travel_min"], ["max_terminal_delay_min", "max_actual_travel_min"])


def stop_monthly(daily: DataFrame) -> DataFrame:
    """G15 f_train_stop_monthly."""
    keys = [k for k in STOP_CELL if k != "date_id"]
    return rollup_monthly(daily, keys,
                          ["arrivals_count", "arrivals_on_time", "arrivals_delayed", "sum_arrival_delay_min",
                           "sum_delayed_delay_min", "cancelled_count"], [], ["max_arrival_delay_min"])


def dep_monthly(daily: DataFrame) -> DataFrame:
    """G17 f_train_dep_monthly."""
    keys = [k for k in STOP_CELL if k != "date_id"]
    return rollup_monthly(daily, keys,
                          ["departures_count", "departures_on_time", "departures_delayed",
                           "sum_departure_delay_min", "sum_delayed_delay_min", "cancelled_count"], [],
                          ["max_departure_delay_min"])


def disruption_monthly(daily: DataFrame) -> DataFrame:
    """G16 f_train_disruption_monthly (runs counts summed as the reference does)."""
    keys = [k for k in DIS_CELL if k != "date_id"]
    return rollup_monthly(daily, keys, ["occurrences_count", "runs_count", "runs_total_count"])


__all__ = [
    "Window_", "runs_in_window", "ends_for", "journeys", "lateness", "header_causes", "with_type_version", "run_resolved",
    "run_daily", "stop_daily", "dep_daily", "disruption_resolved", "disruption_daily", "month_window",
    "run_monthly", "stop_monthly", "dep_monthly", "disruption_monthly", "OPEN_END",
]
