"""Structured Streaming wiring of the live feeds.

One streaming query per feed (E9: a failing feed does not stop the other). The source is the directory where the pages of
API fetches land. Each micro-batch of operations, inside ``foreachBatch``:

1. assemble (A7, A9, ``perron.streaming.assembly``): pages of a fetch may arrive in several batches; those of a fetch that
   is not whole yet are carried on, a bad or expired fetch is an ERR cycle and is dropped whole;
2. each whole fetch is a cycle. Cycles are taken in the order of their runs; one that is not newer than all before it is
   STALE (E6); the others are diffed against their predecessor, the first against the state, all in one join (E3);
3. intent: the delta is written with the batch's version, once, and counted from there;
4. sink: versions not logged yet are added to the log (C6, D14), a version directory partitioned by operating date, so
   that only the partitions of the delta's dates are read;
5. outcomes (E7) with the sink's result: if it fails, cycles with a delta are ERR and the state stays before the first of
   them (E8), so the next cycle brings the same changes again; an EMPTY cycle always moves the state;
6. the state, the heartbeat rows (E10, E11) and, last, the commit record that names the state's version.

All of these are versions of the batch's id: a replay overwrites them and adds nothing, and what a crash left without a
commit record is not seen by any later batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perron.operators import shred
from perron.operators.versions import read_versions, version_ids, write_version
from perron.plans import live as LV
from perron.plans.ops_reports import heartbeat_rows
from perron.streaming import assembly


def _latest_state(spark: SparkSession, state_root: str, before: int | None = None) -> DataFrame | None:
    """Newest committed version directory ``v=<batch id>`` under ``state_root`` (or None).

    A batch reads versions below its own id only, so that its replay starts from what its first run read and never
    reads the directory that it overwrites.
    """
    ids = version_ids(spark, state_root, before)
    return spark.read.parquet(f"{state_root}/v={ids[-1]}") if ids else None


LOG = ("schedule_id bigint, order_id bigint, train_order_id bigint, dsta_id bigint, train_status string, actual_arrival timestamp, "
       "actual_departure timestamp, arrival_delay_min int, departure_delay_min int, is_confirmed boolean, is_cancelled boolean, "
       "actual_sequence int, change_hash string, snapshot_ts timestamp, operating_date date")
LOG_COLUMNS = [c.split()[0] for c in LOG.split(", ")]


def run_rows(pages: DataFrame, station_id) -> DataFrame:
    """Trains of assembled pages with the E2 hash at ``station_id``, as rows of their cycle (``seq``, ``snapshot_ts``)."""
    t = pages.select("seq", "snapshot_ts", F.explode("trains").alias("t"))
    t = t.select("seq", "snapshot_ts", F.col("t.trainOrderId").alias("train_order_id"), F.col("t.operatingDate").alias("operating_date"),
                 F.col("t.scheduleId").alias("schedule_id"), F.col("t.orderId").alias("order_id"), F.col("t.trainStatus").alias("trainStatus"),
                 F.col("t.stations").alias("stations"))
    return LV.with_run_hash(t, station_id)


def diff_in_order(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    """E3 over the cycles of a batch (``seq`` from 1): each against its predecessor, the first against the state."""
    facts = ["seq", *LV.RUN_KEY, "change_hash", "is_final"]
    prev = rows.withColumn("seq", F.col("seq") + 1).select(*facts)
    if state is not None:
        prev = prev.unionByName(state.withColumn("seq", F.lit(1)).select(*facts))
    return LV.diff_runs(prev, rows, key=["seq", *LV.RUN_KEY])


def tracking_rows(delta: DataFrame) -> DataFrame:
    """D14 one log row per changed train and station; a text that is no timestamp becomes null, a bad date fails the write."""
    x = delta.select("*", F.explode("stations").alias("s"))
    return x.select(
        "schedule_id", "order_id", "train_order_id", F.col("s.stationId").alias("dsta_id"), F.col("trainStatus").alias("train_status"),
        F.col("s.actualArrival").try_cast("timestamp").alias("actual_arrival"), F.col("s.actualDeparture").try_cast("timestamp").alias("actual_departure"),
        F.col("s.arrivalDelayMinutes").alias("arrival_delay_min"), F.col("s.departureDelayMinutes").alias("departure_delay_min"),
        F.coalesce("s.isConfirmed", F.lit(False)).alias("is_confirmed"), F.coalesce("s.isCancelled", F.lit(False)).alias("is_cancelled"),
        F.col("s.actualSequenceNumber").alias("actual_sequence"), "change_hash", "snapshot_ts", F.col("operating_date").cast("date").alias("operating_date"))


def read_log(spark: SparkSession, out_root: str, before: int | None = None) -> DataFrame:
    """The operations tracking log; columns LOG_COLUMNS, partitioned by operating date within each batch's version."""
    log = read_versions(spark, f"{out_root}/operation_tracking_log", before, LOG)
    return (spark.createDataFrame([], LOG) if log is None else log).select(*LOG_COLUMNS)


def append_log(spark: SparkSession, delta: DataFrame, batch_id: int, out_root: str) -> None:
    """The sink: adds the delta's versions that are not logged yet (C6), looking at the delta's dates only."""
    rows = tracking_rows(delta)
    log = read_log(spark, out_root, batch_id)
    days = [r[0] for r in rows.select("operating_date").distinct().collect()]  # the days of a few fetches
    if days:
        log = log.where(F.col("operating_date").isin(days) | F.col("operating_date").isNull())
    write_version(LV.append_versions(log, rows.select(*LOG_COLUMNS)).select(*LOG_COLUMNS), f"{out_root}/operation_tracking_log", batch_id, ["operating_date"])


def _last_commit(spark: SparkSession, out_root: str, feed: str, before: int) -> dict:
    """The record of the last committed batch below ``before``: batch_id, state_version; empty for the first batch."""
    root = f"{out_root}/commit_{feed}"
    ids = version_ids(spark, root, before)
    return spark.read.parquet(f"{root}/v={ids[-1]}").first().asDict() if ids else {}


Sink = Callable[[SparkSession, DataFrame, int, str], None]


def operations_batch(spark: SparkSession, batch: DataFrame, batch_id: int, out_root: str, station_id, sink: Sink = append_log,
                     now=None, expiry: dt.timedelta = assembly.EXPIRY, max_pages: int = assembly.MAX_PAGES) -> None:
    """The ``foreachBatch`` body for the operations feed (see the module's text). ``batch``: object_name, payload."""
    at = {name: f"{out_root}/{name}_operations" for name in ("pages", "runs", "delta", "state", "commit")}
    last = _last_commit(spark, out_root, "operations", batch_id)
    runs = carried = state = None
    if last:
        runs = spark.read.schema(assembly.RUNS).parquet(f"{at['runs']}/v={last['batch_id']}")
        carried = spark.read.schema(assembly.PAGES).parquet(f"{at['pages']}/v={last['batch_id']}").join(runs.where("verdict = 'PENDING'").select("run_key"), "run_key", "left_semi")
    if last.get("state_version") is not None:
        state = spark.read.parquet(f"{at['state']}/v={last['state_version']}")
    # assemble; a replay overwrites, and reads nothing that it writes
    pages = assembly.first_files(write_version(assembly.gather(assembly.page_rows(batch), carried, runs), at["pages"], batch_id))
    found = assembly.verdicts(pages, expiry, max_pages)
    cycles = [r.asDict() for r in found.orderBy("run_at", "run_key").collect()]  # a row for each fetch of this batch
    write_version(assembly.remembered(runs, found), at["runs"], batch_id)

    newest = state.agg(F.max("snapshot_ts")).first()[0] if state is not None else None
    n_fresh = 0
    for c in cycles:
        c["seq"], c["stale"], c["n"] = None, False, 0
        if c["verdict"] == "COMPLETE":
            c["stale"] = newest is not None and c["generated_at"] <= newest
            if not c["stale"]:
                newest, n_fresh = c["generated_at"], n_fresh + 1
                c["seq"] = n_fresh
    fresh = {c["seq"]: c for c in cycles if c["seq"]}
    error = None
    if fresh:
        stamps = spark.createDataFrame([(c["run_key"], k, c["generated_at"]) for k, c in fresh.items()], "run_key string, seq int, snapshot_ts timestamp")
        rows = run_rows(pages.select("run_key", "trains").join(F.broadcast(stamps), "run_key"), station_id)
        delta = write_version(diff_in_order(rows, state), at["delta"], batch_id)
        for r in delta.groupBy("seq").count().collect():
            fresh[r["seq"]]["n"] = r["count"]
        if any(c["n"] for c in fresh.values()):
            try:
                sink(spark, delta, batch_id, out_root)
            except Exception as e:  # whatever the sink raises is the cycle's outcome (E7)
                error = f"{type(e).__name__}: {e}"[:1000]
    # The state moves up to the last cycle before the first that may not move it
    facts = spark.createDataFrame([(c["run_key"], c["generated_at_text"], c["n"], c["stale"], c["reason"] if c["verdict"] in ("BAD", "EXPIRED") else error if c["n"] else None, c["seq"])
                                   for c in cycles if c["verdict"] != "PENDING"],
                                  "run_ts string, generated_at_text string, delta_count bigint, stale boolean, error string, seq int")
    facts = facts.withColumn("now", F.current_timestamp() if now is None else F.lit(now).cast("timestamp"))
    beats = heartbeat_rows(facts, "operations").join(facts.select("run_ts", "error", "seq"), "run_ts")
    moves = beats.where("seq is not null").select("seq", LV.state_may_advance(F.col("outcome"), F.lit(error is None)).alias("moves")).collect()
    stuck = min([r["seq"] for r in moves if not r["moves"]], default=n_fresh + 1)
    version = last.get("state_version")
    if stuck > 1:
        write_version(rows.where(F.col("seq") == stuck - 1).drop("seq"), at["state"], batch_id)
        version = batch_id
    write_version(beats.drop("feed", "seq"), f"{out_root}/heartbeat/feed=operations", batch_id)
    write_version(spark.createDataFrame([(batch_id, version)], "batch_id bigint, state_version bigint"), at["commit"], batch_id)


def start_operations_stream(spark: SparkSession, snapshot_dir: str, out_root: str, checkpoint: str,
                            station_id, trigger: dict | None = None, sink: Sink = append_log):
    """Start the operations live query (``trigger`` e.g. ``{"availableNow": True}``
    or ``{"processingTime": "200 seconds"}``)."""
    src = spark.readStream.option("wholetext", True).text(snapshot_dir)
    src = src.select(F.col("_metadata.file_path").alias("object_name"), F.col("value").alias("payload"))

    def body(df, bid):
        operations_batch(spark, df, bid, out_root, station_id, sink)

    q = src.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    q = q.trigger(**(trigger or {"processingTime": "200 seconds"}))
    return q.start()


def disruption_rows(snapshots: DataFrame) -> DataFrame:
    """E4 flattened affected-route rows of parsed disruption snapshots (last one wins)."""
    d = snapshots.select(F.col("p.generatedAt").cast("timestamp").alias("generated_at"),
                         F.posexplode("p.disruptions").alias("dpos", "d"))
    a = d.select("generated_at", "dpos", F.col("d.disruptionTypeCode").alias("disruption_type_code"),
                 F.col("d.message").alias("message"), F.posexplode("d.affectedRoutes").alias("apos", "a"))
    rows = a.select("generated_at", "dpos", "apos",
                    F.col("a.scheduleId").alias("schedule_id"), F.col("a.orderId").alias("order_id"),
                    F.col("a.trainOrderId").alias("train_order_id"),
                    F.col("a.operatingDate").cast("date").alias("operating_date"), F.col("a.stationId").alias("dsta_id"),
                    F.col("a.sequenceNumber").alias("sequence_number"), "disruption_type_code", "message")
    return LV.flatten_disruptions(rows, ["dpos", "apos"], ["generated_at"])


def disruptions_batch(spark: SparkSession, batch: DataFrame, batch_id: int, log_path: str, state_root: str,
                      heartbeat_path: str) -> None:
    """The ``foreachBatch`` body for the disruptions feed: E5 diff of each snapshot
    against its predecessor, then the SCD2 log (C5) rewritten as a new version."""
    if "payload" not in batch.columns:
        batch = batch.select(F.lit(None).cast("string").alias("object_name"), F.col("value").alias("payload"))
    parsed, bad = shred.validate(batch, "disruptions")
    state = _latest_state(spark, state_root, batch_id)
    rows = disruption_rows(parsed)
    if state is not None:
        rows = LV.not_stale(rows, state.agg(F.max("generated_at")).first()[0])
    snaps = rows.select("generated_at").distinct()
    ranked = snaps.withColumn("_seq", F.row_number().over(Window.orderBy("generated_at")))  # snapshots of one batch
    cur = rows.join(ranked, "generated_at")
    prev = cur.withColumn("_seq", F.col("_seq") + 1)
    if state is not None:
        prev = prev.unionByName(state.withColumn("_seq", F.lit(1)), allowMissingColumns=True)
    cols = LV.DIS_KEY + LV.DIS_TRACKED + ["change_hash"]
    key = ["_seq"] + LV.DIS_KEY
    j = cur.select("_seq", "generated_at", *cols).alias("c").join(
        prev.select("_seq", *cols).alias("p"), LV._null_safe_join(key, "c", "p"), "full_outer")
    top = ranked.agg(F.max("_seq")).first()[0] or 0
    seq = F.coalesce(F.col("c._seq"), F.col("p._seq"))
    stamp = ranked.select(F.col("_seq").alias("_s"), F.col("generated_at").alias("_ts"))
    j = j.withColumn("_s", seq).filter(F.col("_s") <= top).join(stamp, "_s")
    in_c, in_p = F.col("c.change_hash").isNotNull(), F.col("p.change_hash").isNotNull()
    changed = j.filter(in_c & (~in_p | (F.col("c.change_hash") != F.col("p.change_hash")))).select(
        *[F.col(f"c.{x}").alias(x) for x in cols], F.col("_ts").alias("snapshot_ts"))
    # runs of the snapshot's day on only: what merely leaves the window has not ended
    ended = j.filter(in_p & ~in_c & (F.col("p.operating_date") >= F.to_date("_ts"))).select(
        *[F.col(f"p.{x}").alias(x) for x in LV.DIS_KEY], F.col("_ts").alias("snapshot_ts"))
    log = _latest_state(spark, log_path, batch_id)
    if log is None:  # first batch
        log = spark.createDataFrame([], "operating_date date, schedule_id bigint, train_order_id bigint, "
                                        "dsta_id bigint, sequence_number int, order_id bigint, "
                                        "disruption_type_code string, message string, change_hash string, "
                                        "is_active boolean, snapshot_ts timestamp")
    new_log = LV.scd2_apply(log, changed, ended)
    # the SCD2 log is rewritten as a new version directory; readers take the newest
    # committed version (_SUCCESS present), so a failed write is never visible
    new_log.write.mode("overwrite").parquet(f"{log_path}/v={batch_id}")
    newest = rows.agg(F.max("generated_at")).first()[0]
    if newest is not None:
        rows.filter(F.col("generated_at") == F.lit(newest)).write.mode("overwrite").parquet(
            f"{state_root}/v={batch_id}")
    n = changed.count() + ended.count()
    outcome = "OK" if n > 0 else ("EMPTY" if newest is not None else "STALE")
    faults = bad.select(F.coalesce(F.regexp_extract("object_name", r"([^/]+)$", 1), F.lit("")).alias("run_ts"), F.lit("ERR").alias("outcome"),
                        F.lit(0).cast("bigint").alias("delta_count"), F.col("reason").alias("error"))
    beats = faults
    if n or newest is not None or not bad.take(1):
        beats = beats.unionByName(spark.createDataFrame([(str(batch_id), outcome, n, None)], faults.schema))
    # a version of the batch's id: a replay overwrites it
    write_version(beats, f"{heartbeat_path}/feed=disruptions", batch_id)


def start_disruptions_stream(spark: SparkSession, snapshot_dir: str, out_root: str, checkpoint: str,
                             trigger: dict | None = None):
    """Start the disruptions live query (a separate query: one feed failing does not stop the other)."""
    src = spark.readStream.option("wholetext", True).text(snapshot_dir)
    src = src.select(F.col("_metadata.file_path").alias("object_name"), F.col("value").alias("payload"))

    def body(df, bid):
        disruptions_batch(spark, df, bid, f"{out_root}/disruption_tracking_log", f"{out_root}/state_disruptions",
                          f"{out_root}/heartbeat")

    q = src.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return q.trigger(**(trigger or {"processingTime": "200 seconds"})).start()
