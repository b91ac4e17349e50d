"""Live snapshots derived from the driver tables.

* user snapshots (events): one snapshot per day, key user_id, state = the
  latest event of the day; tracked fields: event type and ``props.k div 50``;
  final = event type 'signup'. Consecutive days are previous/current.
* disruption snapshots (line items with return flag 'R'): the snapshot of
  day S holds the disruptions of runs on S-1 and S; the message gets an
  update suffix once the run day is over; rows with tax 0.05 are resolved
  after their first snapshot (they end before aging out).
* run tracking (stops): two versions per stop, v = 1, 2 at run date + 6 h x v;
  v1 carries plan times, v2 the measured delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.functions.canon import change_hash
from perron.plans.live import RUN_TRACKED_TYPES
from perron.sources.fixtures import Fixture, _run_date, _tax_pct

TS_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def user_snapshots(fx: Fixture) -> DataFrame:
    ev = fx.table("events").select(
        "event_id", "ts", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"))
    ev = ev.withColumn("day", F.to_date("ts"))
    last = ev.groupBy("day", "user_id").agg(F.max(F.struct("ts", "event_id", "event_type", "k")).alias("e"))
    s = last.select("day", "user_id", F.col("e.event_type").alias("event_type"),
                    F.expr("e.k div 50").cast("int").alias("k_bucket"))
    return s.select("*", change_hash({"eventType": F.col("event_type"), "kBucket": F.col("k_bucket")})
                    .alias("change_hash"), (F.col("event_type") == "signup").alias("is_final"))


def disruption_snapshot_rows(fx: Fixture) -> DataFrame:
    """Rows (snapshot_day, 6-field key, type, message, order) of every disruption snapshot."""
    d = fx._disruption_rows()
    days = F.when(F.col("tax_pct") == 5, F.array(F.col("operating_date"))).otherwise(
        F.array(F.col("operating_date"), F.date_add("operating_date", 1)))
    x = d.select("*", F.explode(days).alias("snapshot_day"))
    msg = F.concat(F.col("message"), F.when(F.col("snapshot_day") > F.col("operating_date"),
                                            F.lit(" (aktualizacja)")).otherwise(F.lit("")))
    return x.select(
        "snapshot_day", F.lit(2001).cast("bigint").alias("schedule_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_orderkey").alias("train_order_id"), "operating_date", (F.col("l_suppkey") % 10).alias("dsta_id"),
        F.col("l_linenumber").alias("sequence_number"), "disruption_type_code", msg.alias("message"),
        "disruption_id")


def track_versions(fx: Fixture) -> DataFrame:
    """Live run-tracking rows, two versions per stop, with the stop-level change hash."""
    s = fx.stop_raw()
    runs = fx.runs().select(F.col("ophe_id").alias("l_orderkey"), "train_status")
    s = s.join(runs, "l_orderkey", "inner")
    delay = F.when(_tax_pct() == 1, F.lit(None).cast("int")).otherwise(F.col("l_quantity").cast("int") - 20)
    x = s.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("v"))
    d = _run_date(F.col("l_orderkey"))
    base = (F.unix_date(d).cast("bigint") * 86400 + F.expr("l_linenumber div 4") * 86400
            + (F.col("l_partkey") % 24) * 3600 + F.col("l_quantity").cast("int") * 60)
    act = F.timestamp_seconds(base + F.coalesce(delay, F.lit(0)) * 60 * (F.col("v") - 1))
    y = x.select(
        d.alias("operating_date"), F.lit(2001).cast("bigint").alias("schedule_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_orderkey").alias("train_order_id"),
        (F.col("l_suppkey") % 10).alias("dsta_id"), "train_status",
        F.when(_tax_pct() != 0, act).alias("actual_arrival"), F.when(_tax_pct() != 5, act).alias("actual_departure"),
        F.when(F.col("v") == 2, delay).alias("arrival_delay_min"),
        F.when(F.col("v") == 2, delay).alias("departure_delay_min"),
        (F.col("l_linestatus") == "F").alias("is_confirmed"), (F.col("l_returnflag") == "R").alias("is_cancelled"),
        F.col("actual_sequence").cast("int").alias("actual_sequence"),
        F.timestamp_seconds(F.unix_date(d).cast("bigint") * 86400 + F.col("v") * 6 * 3600).alias("snapshot_ts"))
    tracked = {"trainStatus": F.col("train_status"),
               "actualArrival": F.date_format("actual_arrival", TS_FMT),
               "actualDeparture": F.date_format("actual_departure", TS_FMT),
               "actualSequenceNumber": F.col("actual_sequence"),
               "isConfirmed": F.col("is_confirmed"), "isCancelled": F.col("is_cancelled")}
    return y.withColumn("change_hash", change_hash(tracked, RUN_TRACKED_TYPES))
