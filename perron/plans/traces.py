"""Trace views H1-H3: one row per source run / stop / affected stop with the
fact-cell keys it maps to and whether it entered the fact (``in_fact``).

They prove the facts: summing trace rows with ``in_fact = 'Y'`` over a cell
gives the fact's measures (tests check this). Rows are limited to the dates
the fact holds (semi join on the fact's date keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.functions.clock import date_key
from perron.plans.gold_dims import plan_ends
from perron.plans.gold_facts import header_causes, lateness, with_type_version
from perron.plans.silver_model import Silver

SH_KEY = ["operating_date", "schedule_id", "order_id", "train_order_id"]


def _sh(s: Silver) -> DataFrame:
    return s.schedule_header.select(*SH_KEY, "category_code", "carrier_code")


def _routes(s: Silver) -> DataFrame:
    return plan_ends(s.schedule_details).select("schedule_id", "order_id", "from_station_id", "to_station_id",
                                                "min_on", "max_on")


def _fact_dates(fact: DataFrame) -> DataFrame:
    return fact.select("date_id").distinct()


def run_daily_trace(s: Silver, run_fact: DataFrame) -> DataFrame:
    """H1 v_run_daily_trace."""
    oh = s.operation_header.select(F.col("id").alias("ophe_id"), *SH_KEY, "train_status")
    x = (oh.join(_sh(s), SH_KEY, "left")
         .join(_routes(s).drop("min_on", "max_on"), ["schedule_id", "order_id"], "left")
         .join(lateness(s.operation_details), "ophe_id", "left"))
    x = with_type_version(x, s)
    st = s.def_train_status.select(F.col("code").alias("train_status"),
                                                     F.col("code").alias("status_code"))
    x = x.join(st, "train_status", "left").withColumn("date_id", date_key("operating_date"))
    x = x.join(_fact_dates(run_fact), "date_id", "left_semi")
    td = F.col("terminal_delay")
    in_fact = (F.col("from_station_id").isNotNull() & F.col("type_valid_from").isNotNull()
               & F.col("status_code").isNotNull())
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "date_id",
        "from_station_id", "to_station_id", "type_valid_from", "status_code",
        "ophe_id", "schedule_id", "order_id", "train_order_id", "train_status", "category_code", "carrier_code",
        "terminal_delay",
        F.when(td.isNull(), F.lit(None)).when(td >= 6, "Y").otherwise("N").alias("is_delayed"),
        F.when(in_fact, "Y").otherwise("N").alias("in_fact"),
    )


def stop_daily_trace(s: Silver, stop_fact: DataFrame) -> DataFrame:
    """H2 v_stop_daily_trace (arrival side; origin skipped)."""
    oh = s.operation_header.select(F.col("id").alias("ophe_id"), *SH_KEY)
    od = s.operation_details
    sd = s.schedule_details.filter(F.col("arrival_time").isNotNull()).select(
        "schedule_id", "order_id", F.col("order_number").alias("planned_sequence"), "arrival_time")
    # what belongs to a run is looked up once a run, then joined to its stops
    runs = oh.join(_sh(s), SH_KEY, "left").join(_routes(s).drop("min_on", "max_on"), ["schedule_id", "order_id"], "left")
    runs = with_type_version(runs, s).withColumn("date_id", date_key("operating_date"))
    runs = runs.join(_fact_dates(stop_fact), "date_id", "left_semi")
    x = runs.join(od, ["ophe_id", "operating_date"], "inner").join(sd, ["schedule_id", "order_id", "planned_sequence"], "inner")
    ok = F.col("is_confirmed") & ~F.col("is_cancelled") & F.col("actual_arrival").isNotNull()
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "date_id",
        "from_station_id", "to_station_id", "type_valid_from", F.col("dsta_id").alias("station_id"),
        F.substring("arrival_time", 1, 2).cast("int").alias("hour_id"),
        "ophe_id", "schedule_id", "order_id", "train_order_id", "category_code", "carrier_code",
        "planned_sequence", "actual_sequence", F.col("arrival_time").alias("planned_arrival_time"),
        F.date_format("actual_arrival", "yyyy-MM-dd HH:mm:ss").alias("actual_arrival"),
        "is_confirmed", "is_cancelled", "arrival_delay_min",
        F.when(ok, F.coalesce("arrival_delay_min", F.lit(0))).alias("eff_delay"),
        F.when(ok, "Y").otherwise("N").alias("is_arrival"),
        F.when(F.col("from_station_id").isNotNull() & F.col("type_valid_from").isNotNull(), "Y")
        .otherwise("N").alias("in_fact"),
    )


def disruption_daily_trace(s: Silver, dis_fact: DataFrame) -> DataFrame:
    """H3 v_disruption_daily_trace, with the source of the cause (TYPE / MESSAGE)."""
    dd = s.disruption_details.withColumn("date_id", date_key("operating_date")).join(_fact_dates(dis_fact), "date_id", "left_semi")
    plan = s.schedule_details.select("schedule_id", "order_id", F.col("order_number").alias("sequence_number"),
                                     F.substring(F.coalesce("arrival_time", "departure_time"), 1, 2).cast("int").alias("hour_id"))
    texts = s.disruption_header.select(F.col("id").alias("dihe_id"), "disruption_type_code", "message")
    x = (dd.join(texts, "dihe_id", "left").join(header_causes(s), "dihe_id", "left").join(plan, ["schedule_id", "order_id", "sequence_number"], "left")
         .join(_routes(s).drop("min_on", "max_on"), ["schedule_id", "order_id"], "left").join(_sh(s), SH_KEY, "left"))
    x = with_type_version(x, s)
    # the fact took a stop that has all that a cell needs
    taken = F.col("from_station_id").isNotNull() & F.col("type_valid_from").isNotNull() & F.col("cause_code").isNotNull() & F.col("hour_id").isNotNull()
    return x.select(
        F.date_format("operating_date", "yyyy-MM-dd").alias("operating_date"), "date_id",
        "from_station_id", "to_station_id", F.col("dsta_id").alias("station_id"), "type_valid_from",
        "hour_id", "cause_code", "cause_source",
        "dihe_id", "schedule_id", "order_id", "train_order_id", "sequence_number", "category_code",
        "carrier_code", "disruption_type_code", "message",
        F.when(taken, "Y").otherwise("N").alias("in_fact"),
    )
