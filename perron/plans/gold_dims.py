"""Gold dimensions F1-F7.

Dimensions keep natural keys; surrogate ids are assigned by
``operators.tableops.assign_ids`` when a dimension is persisted. Facts in
this engine are keyed by natural keys (date key, station ids, category +
carrier + version start, status code, cause code), so they never need a
join back to a surrogate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.functions.clock import clock_minutes, date_key, iso_dow
from perron.functions.ordered import first_row, last_row

# Polish month and weekday names (nominative, capitalised),
# in calendar order; weekdays start on Monday (ISO).
MONTH_NAMES_PL = ["Styczeń", "Luty", "Marzec", "Kwiecień", "Maj", "Czerwiec",
                  "Lipiec", "Sierpień", "Wrzesień", "Październik", "Listopad", "Grudzień"]
DAY_NAMES_PL = ["Poniedziałek", "Wtorek", "Środa", "Czwartek", "Piątek", "Sobota", "Niedziela"]

# Parts of the day by hour range (inclusive bounds).
DAY_PARTS = [(0, 4, "noc"), (5, 8, "szczyt poranny"), (9, 14, "dzień"),
             (15, 18, "szczyt popołudniowy")]
DAY_PART_REST = "wieczór"


def _lit_array(xs: list[str]):
    return F.array(*[F.lit(x) for x in xs])


def calendar_rows(days: DataFrame, date_col: str = "full_date") -> DataFrame:
    """Calendar attributes for a column of dates (F1 columns)."""
    d = F.col(date_col)
    dow = iso_dow(d)
    return days.select(
        date_key(d).alias("id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.element_at(_lit_array(MONTH_NAMES_PL), F.month(d)).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.element_at(_lit_array(DAY_NAMES_PL), dow).alias("day_name"),
        F.weekofyear(d).alias("iso_week"),
        F.when(dow >= 6, "T").otherwise("N").alias("is_weekend"),
    )


def d_date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """F1 with explicit bounds (reference: Jan 1 this year .. Dec 31 next year)."""
    g = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
                              .alias("full_date"))
    return calendar_rows(g)


def d_date_covering(dates: DataFrame, date_col: str) -> DataFrame:
    """F1 over whole years covering the dates in the data (finding 11).

    The bounds come from one global min/max aggregate (partial per task,
    one row to the final task); the calendar itself is generated on the
    executors by ``sequence`` + ``explode``.
    """
    b = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    g = b.select(F.explode(F.sequence(F.trunc("lo", "year"),
                                      F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)))
                 .alias("full_date"))
    return calendar_rows(g)


def d_hour(spark: SparkSession) -> DataFrame:
    """24 hours with label and part of day."""
    h = F.col("id")
    part = F.lit(DAY_PART_REST)
    for lo, hi, name in reversed(DAY_PARTS):
        part = F.when(h.between(lo, hi), name).otherwise(part)
    hh = F.lpad(h.cast("string"), 2, "0")
    return (spark.range(24).select(F.col("id").cast("int").alias("id"))
            .select("id", F.concat(hh, F.lit(":00-"), hh, F.lit(":59")).alias("hour_label"),
                    part.alias("part_of_day")))


def d_station(def_station: DataFrame, def_city: DataFrame) -> DataFrame:
    """station with its city name (left join, city may be unknown)."""
    s = def_station.select("id", F.col("name").alias("station_name"), "dcit_id")
    c = def_city.select(F.col("id").alias("_cid"), F.col("name").alias("city_name"))
    return s.join(c, s.dcit_id == c._cid, "left").select("id", "station_name", "city_name")


def plan_ends(schedule_details: DataFrame) -> DataFrame:
    """G2/G3/G7 in one aggregation per plan: ends, route pair, planned clocks.

    Replaces the reference's min/max subquery + four self-joins by one
    grouped pass (struct min/max keeps the attributes of the end rows).
    """
    sd = schedule_details
    agg = sd.groupBy("schedule_id", "order_id").agg(
        first_row(["order_number"], ["dsta_id", "departure_time", "departure_day"]).alias("f"),
        last_row(["order_number"], ["dsta_id", "arrival_time", "arrival_day"]).alias("l"),
    )
    return agg.select(
        "schedule_id", "order_id",
        F.col("f._o0").alias("min_on"), F.col("l._o0").alias("max_on"),
        F.col("f.dsta_id").alias("from_station_id"), F.col("l.dsta_id").alias("to_station_id"),
        F.col("f.departure_time").alias("dep_time"), F.col("f.departure_day").alias("dep_day"),
        F.col("l.arrival_time").alias("arr_time"), F.col("l.arrival_day").alias("arr_day"),
    )


def d_route(schedule_details: DataFrame, schedule_header: DataFrame | None = None,
            day=None) -> DataFrame:
    """distinct (first station, last station) of plans.

    Full mode: all plans. Daily mode (``day`` given): only plans with a
    timetable header on that day (semi join, so the plan scan is pruned
    by the small header set).
    """
    sd = schedule_details
    if day is not None and schedule_header is not None:
        ords = (schedule_header.filter(F.col("operating_date") == F.lit(day).cast("date"))
                .select("schedule_id", "order_id").distinct())
        sd = sd.join(ords, ["schedule_id", "order_id"], "left_semi")
    return routes(plan_ends(sd))


def routes(ends: DataFrame) -> DataFrame:
    """The distinct (first station, last station) of :func:`plan_ends`."""
    return ends.select("from_station_id", "to_station_id").distinct()


def d_train_type(def_commercial_category: DataFrame, def_carrier: DataFrame,
                 schedule_header: DataFrame) -> DataFrame:
    """category x carrier version, plus composite codes seen in timetables.

    A composite code such as 'A/B' that is not in the category dictionary
    gets the part names joined by ' / ' (code part when unknown) and the
    speed class of its first part.
    """
    cc = def_commercial_category
    ca = def_carrier.select(F.col("code").alias("carrier_code"), F.col("name").alias("carrier_name"),
                            "valid_from", "valid_to")
    base = (cc.select(F.col("code").alias("category_code"), F.col("name").alias("category_name"),
                      "speed_category_code", "carrier_code")
            .join(ca, "carrier_code", "inner"))
    seen = (schedule_header.select("category_code", "carrier_code")
            .filter(F.instr("category_code", "/") > 0).distinct())
    known = cc.select(F.col("code").alias("category_code"), "carrier_code")
    comp = seen.join(known, ["category_code", "carrier_code"], "left_anti")
    p1c = F.split_part(F.col("category_code"), F.lit("/"), F.lit(1))
    p2c = F.split_part(F.col("category_code"), F.lit("/"), F.lit(2))
    comp = comp.select("category_code", "carrier_code", p1c.alias("_p1"), p2c.alias("_p2"))
    p1 = cc.select(F.col("code").alias("_p1"), F.col("carrier_code").alias("_c1"),
                   F.col("name").alias("_n1"), F.col("speed_category_code").alias("_s1"))
    p2 = cc.select(F.col("code").alias("_p2"), F.col("carrier_code").alias("_c2"),
                   F.col("name").alias("_n2"))
    comp = (comp.join(p1, (comp._p1 == p1._p1) & (comp.carrier_code == p1._c1), "left").drop(p1._p1)
            .join(p2, (comp._p2 == p2._p2) & (comp.carrier_code == p2._c2), "left").drop(p2._p2))
    comp = comp.select(
        "category_code",
        F.concat(F.coalesce("_n1", "_p1"), F.lit(" / "), F.coalesce("_n2", "_p2")).alias("category_name"),
        F.col("_s1").alias("speed_category_code"), "carrier_code",
    ).join(ca, "carrier_code", "inner")
    cols = ["category_code", "category_name", "speed_category_code", "carrier_code", "carrier_name",
            "valid_from", "valid_to"]
    return base.select(*cols).unionByName(comp.select(*cols))


def d_train_status(def_train_status: DataFrame) -> DataFrame:
    """status code -> name."""
    return def_train_status.select(F.col("code").alias("status_code"), F.col("name").alias("status_name"))


def d_disruption_cause(def_disruption_cause: DataFrame) -> DataFrame:
    """cause code -> name."""
    return def_disruption_cause.select(F.col("code").alias("cause_code"),
                                       F.col("description").alias("cause_name"))


def planned_minutes(t, day):
    return F.coalesce(day, F.lit(0)) * 1440 + clock_minutes(t)
