"""Live layer: snapshot differencing (E2-E5), version logs (C5, C6, D14, D15),
cycle bookkeeping (E6, E7, E10, E11) and the latest-version view (E12).

Every operator is a DataFrame function, so the same code runs in a batch
job over many snapshots and inside ``foreachBatch`` of the streaming query
(``perron.streaming.live_stream``). A diff is a join of the current
snapshot with the previous one on the record key -- both sides shuffle on
the key once, nothing is held on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.functions.canon import change_hash
from perron.functions.ordered import top1

RUN_KEY = ["train_order_id", "operating_date"]
DIS_KEY = ["schedule_id", "order_id", "train_order_id", "operating_date", "dsta_id", "sequence_number"]
# Key of the disruption log (order_id stored, not matched: it is not stable in the feed).
DIS_LOG_KEY = ["operating_date", "schedule_id", "train_order_id", "dsta_id", "sequence_number"]


def _null_safe_join(keys: Sequence[str], l_alias: str, r_alias: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{l_alias}.{k}").eqNullSafe(F.col(f"{r_alias}.{k}"))
    return cond


# ---- E2 / E3 runs ----------------------------------------------------------------

RUN_TRACKED_TYPES = {"isConfirmed": T.BooleanType(), "isCancelled": T.BooleanType()}


def station_of_interest(stations: Column, station_id) -> Column:
    """E2 the station entry of a run at ``station_id``; else the first station; else null."""
    hit = F.filter(stations, lambda s: s["stationId"] == F.lit(station_id))
    return F.coalesce(F.get(hit, 0), F.get(stations, 0))


def run_tracked(train_status: Column, st: Column) -> dict[str, Column]:
    """E2 the 8 tracked fields of a run at the station (``st`` is a station struct)."""
    return {
        "trainStatus": train_status,
        "plannedArrival": st["plannedArrival"],
        "plannedDeparture": st["plannedDeparture"],
        "actualArrival": st["actualArrival"],
        "actualDeparture": st["actualDeparture"],
        "actualSequenceNumber": st["actualSequenceNumber"],
        "isConfirmed": F.coalesce(st["isConfirmed"], F.lit(False)),
        "isCancelled": F.coalesce(st["isCancelled"], F.lit(False)),
    }


def with_run_hash(trains: DataFrame, station_id, stations_col: str = "stations",
                  status_col: str = "trainStatus") -> DataFrame:
    """Adds ``change_hash`` and ``is_final`` (confirmed or cancelled at the station)."""
    st = station_of_interest(F.col(stations_col), station_id)
    tracked = run_tracked(F.col(status_col), st)
    final = F.coalesce(st["isConfirmed"], F.lit(False)) | F.coalesce(st["isCancelled"], F.lit(False))
    return trains.withColumn("change_hash", change_hash(tracked, RUN_TRACKED_TYPES)).withColumn("is_final", final)


def diff_runs(prev: DataFrame, curr: DataFrame, key: Sequence[str] = RUN_KEY) -> DataFrame:
    """E3 rows of ``curr`` to emit: new key, or previous not final and hash changed.

    Both inputs carry ``change_hash`` and ``is_final``; a final previous
    record is frozen (later changes are ignored). Key match is null-safe.
    """
    p = prev.select(*key, F.col("change_hash").alias("_ph"), F.col("is_final").alias("_pf"))
    j = curr.alias("c").join(p.alias("p"), _null_safe_join(key, "c", "p"), "left")
    new = F.col("_ph").isNull()
    keep = new | (~F.col("_pf") & (F.col("_ph") != F.col("c.change_hash")))
    return (j.filter(keep).withColumn("diff_kind", F.when(new, "new").otherwise("changed"))
            .select("c.*", "diff_kind"))


# ---- E4 / E5 disruptions ---------------------------------------------------------

DIS_TRACKED = ["disruption_type_code", "message"]


def flatten_disruptions(snapshot_rows: DataFrame, order_cols: Sequence[str],
                        snapshot_cols: Sequence[str] = ()) -> DataFrame:
    """E4 one row per 6-field key (per snapshot); on duplicates the last in document order wins.

    ``order_cols`` give the document order (e.g. disruption and route
    positions from ``posexplode``); ``snapshot_cols`` identify the snapshot
    when several are flattened at once.
    """
    x = top1(snapshot_rows, [*snapshot_cols, *DIS_KEY], [(c, "desc") for c in order_cols])
    return x.withColumn("change_hash", change_hash({"disruptionTypeCode": F.col("disruption_type_code"),
                                                    "message": F.col("message")}))


def diff_disruptions(prev: DataFrame, curr: DataFrame, ended_min_date=None) -> tuple[DataFrame, DataFrame]:
    """E5 ``(changed, ended)`` between two flattened snapshots.

    changed: current rows that are new or whose hash differs. ended:
    previous rows whose key is gone, only for ``operating_date >=
    ended_min_date`` when given (a null date counts as older than any date).
    """
    cols = DIS_KEY + DIS_TRACKED + ["change_hash"]
    c = curr.select(*cols)
    p = prev.select(*cols)
    j = c.alias("c").join(p.alias("p"), _null_safe_join(DIS_KEY, "c", "p"), "full_outer")
    in_c = F.col("c.change_hash").isNotNull()
    in_p = F.col("p.change_hash").isNotNull()
    changed = j.filter(in_c & (~in_p | (F.col("c.change_hash") != F.col("p.change_hash")))).select(
        *[F.col(f"c.{x}").alias(x) for x in cols])
    ended_f = in_p & ~in_c
    if ended_min_date is not None:
        ended_f = ended_f & F.coalesce(F.col("p.operating_date") >= F.lit(ended_min_date), F.lit(False))
    ended = j.filter(ended_f).select(*[F.col(f"p.{x}").alias(x) for x in DIS_KEY + DIS_TRACKED])
    return changed, ended


# ---- C6 / D14 append-only version log ----------------------------------------------

def append_versions(log: DataFrame, batch: DataFrame) -> DataFrame:
    """C6 rows to append: versions not logged yet for (date, train, station, hash).

    The train id is matched null-safely (the reference's ``NVL(x, -1)``);
    duplicates inside the batch keep the earliest snapshot (finding 5).
    The comparison is with every logged version of the key (the reference's
    rule: a hash seen before is not logged again).
    """
    key = ["operating_date", "train_order_id", "dsta_id", "change_hash"]
    b = batch.filter(F.col("change_hash").isNotNull())
    # one shuffle for both: the keys of the log come first in their group, which takes nulls as equal
    both = b.withColumn("_new", F.lit(True)).unionByName(log.select(*key).withColumn("_new", F.lit(False)), allowMissingColumns=True)
    return top1(both, key, ["_new", "snapshot_ts", "schedule_id", "order_id"]).filter("_new").select(*batch.columns)


# ---- C5 / D15 SCD2 log -------------------------------------------------------------

def scd2_apply(log: DataFrame, changed: DataFrame, ended: DataFrame, key: Sequence[str] = DIS_LOG_KEY) -> DataFrame:
    """C5 apply one or more snapshots' changed/ended sets to an SCD2 log.

    Events of a key are taken in snapshot order and the last one decides
    (finding 4): a run of 'changed' events with a new hash each inserts a
    version; only the key's final event may leave an active version (when
    it is a 'changed'); an 'ended' final event, or a newer hash, closes the
    previously active version. Inserting a hash equal to the active one is
    a no-op. Returns the whole new log.
    """
    return scd2_events(log, scd2_kinds(changed, ended, key), key)


def scd2_kinds(changed: DataFrame, ended: DataFrame, key: Sequence[str] = DIS_LOG_KEY) -> DataFrame:
    """The events of :func:`scd2_events` from separate sets."""
    ev_c = changed.select(*key, "order_id", *DIS_TRACKED, "change_hash", "snapshot_ts",
                          F.lit("C").alias("_kind"))
    ev_e = ended.select(*key, F.lit(None).cast("bigint").alias("order_id"),
                        *[F.lit(None).cast("string").alias(c) for c in DIS_TRACKED],
                        F.lit(None).cast("string").alias("change_hash"), "snapshot_ts", F.lit("E").alias("_kind"))
    return ev_c.unionByName(ev_e)


def scd2_events(log: DataFrame, ev: DataFrame, key: Sequence[str] = DIS_LOG_KEY) -> DataFrame:
    """C5 for events with ``_kind`` C (changed) or E (ended; no order, texts or hash); see :func:`scd2_apply`."""
    key = list(key)
    # key columns may be null (train id): a window takes nulls as equal; on the columns themselves, a filter on them comes before it
    w = Window.partitionBy(*key).orderBy("snapshot_ts", "_kind")
    ev = (ev.withColumn("_prev_hash", F.lag("change_hash").over(w))
          .withColumn("_prev_kind", F.lag("_kind").over(w))
          .withColumn("_is_last", F.lead("_kind").over(w).isNull()))
    active = log.filter(F.col("is_active")).select(*key, F.col("change_hash").alias("_active_hash"))
    ev = ev.alias("e").join(active.alias("a"), _null_safe_join(key, "e", "a"), "left") \
        .select("e.*", "_active_hash")
    prior = F.when(F.col("_prev_kind").isNull(), F.col("_active_hash")) \
        .when(F.col("_prev_kind") == "C", F.col("_prev_hash"))
    # the key's final event decides what stays active
    ev = ev.withColumn("_last_kind", F.last("_kind").over(w.rowsBetween(Window.unboundedPreceding,
                                                                         Window.unboundedFollowing)))
    ins = ev.filter((F.col("_kind") == "C") & ~F.col("change_hash").eqNullSafe(prior))
    wi = Window.partitionBy(*key).orderBy(F.col("snapshot_ts").desc())
    ins = ins.withColumn("_newest", F.row_number().over(wi) == 1)
    new_rows = ins.select(*key, "order_id", *DIS_TRACKED, "change_hash",
                          (F.col("_newest") & (F.col("_last_kind") == "C")).alias("is_active"), "snapshot_ts")
    # whatever a key's events end with, an inserted version or an end closes the version that was active before
    shut = ev.filter(F.col("_kind") == "E").select(*key).unionByName(ins.select(*key)).distinct().withColumn("_shut", F.lit(True))
    old = log.alias("l").join(shut.alias("x"), _null_safe_join(key, "l", "x"), "left")
    close = F.col("l.is_active") & F.coalesce("_shut", F.lit(False))
    old = old.select(*[F.col(f"l.{c}").alias(c) for c in log.columns if c != "is_active"],
                     F.when(close, F.lit(False)).otherwise(F.col("l.is_active")).alias("is_active"))
    return old.select(*log.columns).unionByName(new_rows.select(*log.columns))


# ---- E6 / E7 / E10 / E11 / E12 ----------------------------------------------------

def not_stale(snapshots: DataFrame, state_generated_at, col: str = "generated_at") -> DataFrame:
    """E6 keep snapshots newer than the state (compared as instants, not text)."""
    if state_generated_at is None:
        return snapshots
    return snapshots.filter(F.col(col) > F.lit(state_generated_at).cast("timestamp"))


def lag_seconds(generated_at_text: Column, now: Column) -> Column:
    """E10 now - generatedAt in seconds; null when the text is missing or not a timestamp."""
    t = F.try_to_timestamp(generated_at_text)
    return F.unix_timestamp(now) - F.unix_timestamp(t)


def outcome(delta_count: Column, stale: Column, error: Column) -> Column:
    """E7 cycle outcome: ERR / STALE / EMPTY / OK."""
    return (F.when(error.isNotNull(), "ERR").when(stale, "STALE").when(delta_count == 0, "EMPTY").otherwise("OK"))


def state_may_advance(outcome_col: Column, sink_ok: Column) -> Column:
    """E8 the baseline moves on OK only if the sink succeeded, always on EMPTY."""
    return (outcome_col == "EMPTY") | ((outcome_col == "OK") & sink_ok)


def heartbeat_append(log: DataFrame, rows: DataFrame) -> DataFrame:
    """E11 heartbeat log unique on (run_ts, feed); duplicates are ignored and every row stays."""
    new = rows.dropDuplicates(["run_ts", "feed"]).join(log.select("run_ts", "feed"), ["run_ts", "feed"], "left_anti")
    return log.unionByName(new.select(*log.columns))


def latest_versions(log: DataFrame, in_window: Column, tie: str = "id") -> DataFrame:
    """E12 latest version per (date, train, station) among versions inside the window.

    The window filter is applied before ranking (as the boards do), so the
    latest version is the latest one inside the time window.
    """
    return top1(log.filter(in_window), ["operating_date", "train_order_id", "dsta_id"],
                [("snapshot_ts", "desc"), (tie, "desc")])
