"""Pipeline step report (H25) and live cycle bookkeeping rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.plans import live as LV

TOTAL_LABEL = "RAZEM"
EXCLUDED_STEP = "send_report"


def _tenths(start, end) -> F.Column:
    """Seconds between two instants rounded half-up to 0.1 s, computed on integer microseconds."""
    us = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    q = F.signum(us).cast("bigint") * ((F.abs(us) + 50_000) - (F.abs(us) + 50_000) % 100_000) / 100_000
    return (q.cast("bigint") / 10.0)


def step_report(steps: DataFrame) -> DataFrame:
    """H25 per pipeline run: each step (except the report step itself) with status,
    start, end and duration, plus one total row per run summing the durations
    that exist (nulls skipped)."""
    x = steps.filter(F.col("step_name") != EXCLUDED_STEP).select(
        "pipeline_run_id", "step_name", "status", "start_time", "end_time",
        F.when(F.col("start_time").isNotNull() & F.col("end_time").isNotNull(),
               _tenths(F.col("start_time"), F.col("end_time"))).alias("seconds"))
    rows = x.select("pipeline_run_id", "step_name", "status",
                    F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start_time"),
                    F.date_format("end_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("end_time"), "seconds",
                    F.lit(0).alias("is_total"))
    total = x.groupBy("pipeline_run_id").agg(
        F.round(F.coalesce(F.sum("seconds"), F.lit(0.0)), 1).alias("seconds")).select(
        "pipeline_run_id", F.lit(TOTAL_LABEL).alias("step_name"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("start_time"), F.lit(None).cast("string").alias("end_time"), "seconds",
        F.lit(1).alias("is_total"))
    return rows.unionByName(total)


def heartbeat_rows(cycles: DataFrame, feed: str) -> DataFrame:
    """E7/E10/E11 one heartbeat row per cycle: outcome, delta count, lag.

    ``cycles``: (run_ts, generated_at_text, now, delta_count, stale, error).
    """
    return cycles.select(
        "run_ts", F.lit(feed).alias("feed"),
        LV.outcome(F.col("delta_count"), F.col("stale"), F.col("error")).alias("outcome"),
        F.col("delta_count").cast("bigint").alias("delta_count"),
        F.col("generated_at_text").alias("generated_at"),
        LV.lag_seconds(F.col("generated_at_text"), F.col("now")).alias("lag_seconds"))
