"""JSON shredding (B1-B8) and payload validation.

A top-level array path is an inner unnest (``explode``); a nested path is an
outer unnest (``explode_outer``): a parent with an empty array still yields
one row with null children, as JSON_TABLE's NESTED PATH does. Values are
parsed as text first and cast when written (B8, ANSI casts fail loudly).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.sources.schemas import FEEDS, required


CORRUPT = "_corrupt_record"


def parse(landing: DataFrame, feed: str) -> DataFrame:
    """``(object_name, payload)`` -> adds ``p`` (parsed struct).

    A payload that is not valid JSON yields a null ``p`` or a struct whose
    ``_corrupt_record`` holds the text (PERMISSIVE mode).
    """
    schema = T.StructType(FEEDS[feed].fields + [T.StructField(CORRUPT, T.StringType(), True)])
    return landing.withColumn("p", F.from_json("payload", schema,
                                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))


def is_corrupt(p: str = "p") -> Column:
    return F.col(p).isNull() | F.col(f"{p}.{CORRUPT}").isNotNull()


def checked(landing: DataFrame, feed: str) -> DataFrame:
    """A7 the parsed documents with the ``reason`` for which a document is rejected, by the feed's required fields; null if it is valid."""
    reason = (F.when(is_corrupt("p"), F.lit("not a JSON object"))
              .when(~F.coalesce(required(feed), F.lit(False)), F.lit("required field missing")))
    return parse(landing, feed).withColumn("reason", reason)


def validate(landing: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """A7 split into (valid, quarantined with reason)."""
    x = checked(landing, feed)
    valid = x.filter(F.col("reason").isNull()).drop("reason")
    bad = x.filter(F.col("reason").isNotNull()).select("object_name", "payload", "reason")
    return valid, bad


def ts(c: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP (UTC instant)."""
    return c.cast("timestamp")


def explode_array(parsed: DataFrame, field: str, carry: list[str] | None = None) -> DataFrame:
    """B1 top-level array of objects -> one row per element (struct fields as columns)."""
    carry = carry or []
    x = parsed.select("object_name", *[F.col(f"p.{c}").alias(c) for c in carry], F.explode(f"p.{field}").alias("e"))
    return x.select("object_name", *carry, "e.*")


def explode_map(parsed: DataFrame, field: str) -> DataFrame:
    """B6 object with dynamic keys -> (k, v) rows."""
    return parsed.select("object_name", F.explode(f"p.{field}").alias("k", "v"))


def operations_rows(parsed: DataFrame) -> DataFrame:
    """B3 trains x stations (stations outer-unnested)."""
    t = parsed.select("object_name", F.col("p.generatedAt").alias("generated_at"),
                      F.explode("p.trains").alias("t"))
    s = t.select("object_name", "generated_at", "t.scheduleId", "t.orderId", "t.trainOrderId", "t.operatingDate",
                 "t.trainStatus", F.explode_outer("t.stations").alias("s"))
    return s.select(
        "object_name", ts(F.col("generated_at")).alias("snapshot_ts"),
        F.col("scheduleId").alias("schedule_id"), F.col("orderId").alias("order_id"),
        F.col("trainOrderId").alias("train_order_id"), F.col("operatingDate").cast("date").alias("operating_date"),
        F.col("trainStatus").alias("train_status"),
        F.col("s.stationId").alias("dsta_id"), F.col("s.plannedSequenceNumber").alias("planned_sequence"),
        F.col("s.actualSequenceNumber").alias("actual_sequence"),
        ts(F.col("s.actualArrival")).alias("actual_arrival"), ts(F.col("s.actualDeparture")).alias("actual_departure"),
        F.col("s.arrivalDelayMinutes").alias("arrival_delay_min"),
        F.col("s.departureDelayMinutes").alias("departure_delay_min"),
        F.col("s.isConfirmed").alias("is_confirmed"), F.col("s.isCancelled").alias("is_cancelled"))


def schedule_route_dates(parsed: DataFrame) -> DataFrame:
    """B2/B5 routes x running dates, root ``generatedAt`` carried down."""
    r = parsed.select("object_name", F.col("p.generatedAt").alias("generated_at"), F.explode("p.routes").alias("r"))
    x = r.select("object_name", "generated_at", "r.*").withColumn("d", F.explode_outer("operatingDates"))
    return x.select(
        "object_name", ts(F.col("generated_at")).alias("snapshot_ts"),
        F.col("d").cast("date").alias("operating_date"), F.col("scheduleId").alias("schedule_id"),
        F.col("orderId").alias("order_id"), F.col("trainOrderId").alias("train_order_id"), "name",
        F.col("carrierCode").alias("carrier_code"), F.col("commercialCategorySymbol").alias("category_code"),
        F.col("nationalNumber").alias("national_number"),
        F.col("internationalArrivalNumber").alias("intl_arrival_number"),
        F.col("internationalDepartureNumber").alias("intl_departure_number"))


def schedule_stops(parsed: DataFrame) -> DataFrame:
    """B3 routes x stations (plan stops)."""
    r = parsed.select("object_name", F.col("p.generatedAt").alias("generated_at"), F.explode("p.routes").alias("r"))
    s = r.select("object_name", "generated_at", F.col("r.scheduleId").alias("schedule_id"),
                 F.col("r.orderId").alias("order_id"), F.explode_outer("r.stations").alias("s"))
    return s.select(
        "object_name", ts(F.col("generated_at")).alias("snapshot_ts"), "schedule_id", "order_id",
        F.col("s.orderNumber").alias("order_number"), F.col("s.stationId").alias("dsta_id"),
        F.col("s.arrivalTime").alias("arrival_time"), F.col("s.arrivalDay").alias("arrival_day"),
        F.col("s.arrivalPlatform").alias("arrival_platform"), F.col("s.arrivalTrack").alias("arrival_track"),
        F.col("s.arrivalCommercialCategory").alias("arrival_category"),
        F.col("s.arrivalTrainNumber").alias("arrival_train_no"),
        F.col("s.departureTime").alias("departure_time"), F.col("s.departureDay").alias("departure_day"),
        F.col("s.departurePlatform").alias("departure_platform"), F.col("s.departureTrack").alias("departure_track"),
        F.col("s.departureCommercialCategory").alias("departure_category"),
        F.col("s.departureTrainNumber").alias("departure_train_no"),
        F.col("s.stopTypeId").alias("dstty_id"))


def disruption_rows(parsed: DataFrame) -> DataFrame:
    """B4 disruptions x affected routes."""
    d = parsed.select("object_name", F.col("p.generatedAt").alias("generated_at"), F.explode("p.disruptions").alias("d"))
    a = d.select("object_name", "generated_at", F.col("d.disruptionId").alias("disruption_id"),
                 F.col("d.disruptionTypeCode").alias("disruption_type_code"), F.col("d.message").alias("message"),
                 F.explode_outer("d.affectedRoutes").alias("a"))
    return a.select(
        "object_name", ts(F.col("generated_at")).alias("snapshot_ts"), "disruption_id", "disruption_type_code",
        "message", F.col("a.scheduleId").alias("schedule_id"), F.col("a.orderId").alias("order_id"),
        F.col("a.trainOrderId").alias("train_order_id"), F.col("a.operatingDate").cast("date").alias("operating_date"),
        F.col("a.stationId").alias("dsta_id"), F.col("a.sequenceNumber").alias("sequence_number"))


def city_members(parsed: DataFrame) -> DataFrame:
    """B5 cities x stationIds (scalar array, outer)."""
    c = parsed.select("object_name", F.explode("p.cities").alias("c"))
    return c.select("object_name", F.col("c.name").alias("city_name"), F.col("c.stationCount").alias("station_count"),
                    F.explode_outer("c.stationIds").alias("station_id"))


def live_disruption_delta_rows(parsed: DataFrame) -> DataFrame:
    """B7 live delta documents -> rows of ``changed[*]`` and ``ended[*]`` with their kind."""
    def side(field: str, kind: str) -> DataFrame:
        x = parsed.select(F.col("p.generatedAt").alias("generated_at"), F.explode(f"p.{field}").alias("r"))
        return x.select(
            "generated_at", F.lit(kind).alias("kind"), F.col("r.scheduleId").alias("schedule_id"),
            F.col("r.orderId").alias("order_id"), F.col("r.trainOrderId").alias("train_order_id"),
            F.col("r.operatingDate").cast("date").alias("operating_date"), F.col("r.stationId").alias("dsta_id"),
            F.col("r.sequenceNumber").alias("sequence_number"),
            F.col("r.disruptionTypeCode").alias("disruption_type_code"), F.col("r.message").alias("message"),
            F.col("r.changeHash").alias("change_hash"))
    return side("changed", "changed").unionByName(side("ended", "ended"))
