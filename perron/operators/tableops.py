"""Table write patterns C1-C13 on immutable DataFrames / Parquet.

Parquet has no MERGE, so every write operator is a pure function
``(current table, batch, params) -> new table (and a change set)``; the
caller writes the result as a new version (``publish``) or overwrites only
the touched partitions (dynamic partition overwrite). Joins are on the
table keys, so both sides shuffle once on the key and nothing is collected.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _null_safe_differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


# ---- C1 / C10 -----------------------------------------------------------------

def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 as_of, loaded_col: str = "loaded_at") -> tuple[DataFrame, DataFrame]:
    """C1 null-safe MERGE with no-op skip.

    Returns ``(new_target, changes)``. A matched row is updated (and stamped
    ``as_of``) only when a tracked column differs null-safely; otherwise it
    keeps its old stamp. Unmatched source rows are inserted; target rows
    missing from the source are kept. ``changes`` has one row per inserted
    or updated key with ``op`` ('I'/'U') and ``old_<c>``/``new_<c>`` values
    for ``tracked`` -- the input of ``audit_changes`` (C10).
    """
    keys, tracked = list(keys), list(tracked)
    t = target.select(*keys, *[F.col(c).alias(f"old_{c}") for c in tracked],
                      F.col(loaded_col).alias("old_loaded"), F.lit(True).alias("_in_t"))
    s = source.select(*keys, *[F.col(c).alias(f"new_{c}") for c in tracked], F.lit(True).alias("_in_s"))
    j = t.join(s, keys, "full_outer")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | _null_safe_differs(F.col(f"old_{c}"), F.col(f"new_{c}"))
    op = (F.when(F.col("_in_t").isNull(), "I")
          .when(F.col("_in_s").isNotNull() & differs, "U"))
    j = j.withColumn("op", op)
    stamp = F.lit(as_of).cast("timestamp")
    new_target = j.select(
        *keys,
        *[F.when(F.col("op").isNotNull(), F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in tracked],
        F.when(F.col("op").isNotNull(), stamp).otherwise(F.col("old_loaded")).alias(loaded_col),
    )
    changes = j.filter(F.col("op").isNotNull()).select(
        *keys, "op", *[f"old_{c}" for c in tracked], *[f"new_{c}" for c in tracked])
    return new_target, changes


def audit_changes(changes: DataFrame, table_name: str, keys: Sequence[str], tracked: Sequence[str],
                  as_of, changed_by: str = "perron") -> DataFrame:
    """C10 one audit row per really changed column, values as text.

    Inserts audit every non-null new value (old is null); updates only the
    columns whose value changed. ``business_key`` joins the key values
    with '|'.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(f"old_{c}").cast("string").alias("old_value"),
                                 F.col(f"new_{c}").cast("string").alias("new_value")) for c in tracked])
    x = changes.select(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("business_key"),
                       F.explode(entries).alias("e"))
    return x.filter(~F.col("e.old_value").eqNullSafe(F.col("e.new_value"))).select(
        F.lit(table_name).alias("table_name"), "business_key", "e.column_name", "e.old_value", "e.new_value",
        F.lit(as_of).cast("timestamp").alias("changed_at"), F.lit(changed_by).alias("changed_by"))


# ---- C2 / C3 / C4 / C9 -------------------------------------------------------

def dedup_first(batch: DataFrame, keys: Sequence[str], order_by) -> DataFrame:
    """In-batch dedup: the first row per key by ``order_by`` (explicit, total order).

    ``order_by``: names (ascending) or ``(name, "desc")``. Implemented as a
    grouped struct minimum (``functions.ordered.top1``), which pre-reduces
    the copies of a hot key in every input task before the shuffle.
    """
    from perron.functions.ordered import top1
    return top1(batch, keys, order_by)


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by=None) -> DataFrame:
    """C2 insert-only-new: rows of the batch whose key is not stored yet (deduped)."""
    b = dedup_first(batch, keys, order_by) if order_by is not None else batch.dropDuplicates(list(keys))
    return b.join(target.select(*keys), list(keys), "left_anti")


def deactivate_missing(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                       flag: str = "is_active") -> DataFrame:
    """C3 soft delete: rows absent from the batch get ``flag = false`` (stamps untouched)."""
    present = batch.select(*keys).distinct().withColumn("_present", F.lit(True))
    j = target.join(present, list(keys), "left")
    return j.withColumn(flag, F.when(F.col("_present").isNull(), F.lit(False)).otherwise(F.col(flag))) \
        .drop("_present").select(*target.columns)


def sync_flag(target: DataFrame, batch: DataFrame, keys: Sequence[str], date_col: str,
              flag: str = "is_active") -> DataFrame:
    """C4 windowed activity flag.

    Inside the batch's ``min..max`` date window, ``flag`` = 1 if the key is in
    the batch, else 0; rows outside the window keep their flag. An empty
    batch has a null window and changes nothing. The window bounds are
    scalar subqueries (Catalyst merges them into one global aggregate).
    """
    lo = batch.select(F.min(date_col)).scalar()
    hi = batch.select(F.max(date_col)).scalar()
    present = batch.select(*keys).distinct().withColumn("_present", F.lit(1))
    j = target.join(present, list(keys), "left")
    in_win = F.coalesce(F.col(date_col).between(lo, hi), F.lit(False))
    new_flag = F.when(in_win, F.when(F.col("_present").isNotNull(), 1).otherwise(0)).otherwise(F.col(flag))
    return j.withColumn(flag, new_flag.cast(target.schema[flag].dataType)).select(*target.columns)


def insert_missing(target: DataFrame, generated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C9 generated rows (calendar, hours) inserted where the key is missing."""
    new = generated.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


# ---- C7 / C8 -----------------------------------------------------------------

def recompute_days(fact: DataFrame, new_rows: DataFrame, date_col: str, date_from, date_to) -> DataFrame:
    """C7 delete the window and insert the recomputed rows.

    On storage this is a dynamic partition overwrite of the window's
    partitions; as a DataFrame it is ``rows outside the window`` union ``new``.
    """
    keep = fact.filter(~F.col(date_col).between(F.lit(date_from), F.lit(date_to)))
    return keep.unionByName(new_rows.select(*fact.columns))


def month_bounds(date_from: dt.date, date_to: dt.date) -> tuple[int, int]:
    """C8 months (YYYYMM) touched by the day window, widened to whole months."""
    return date_from.year * 100 + date_from.month, date_to.year * 100 + date_to.month


def recompute_months(fact_monthly: DataFrame, rebuilt: DataFrame, month_col: str, date_from: dt.date,
                     date_to: dt.date) -> DataFrame:
    """C8 drop the touched months and insert them rebuilt from the daily fact."""
    lo, hi = month_bounds(date_from, date_to)
    keep = fact_monthly.filter(~F.col(month_col).between(lo, hi))
    return keep.unionByName(rebuilt.filter(F.col(month_col).between(lo, hi)).select(*fact_monthly.columns))


# ---- C11 ---------------------------------------------------------------------

def assign_ids(existing: DataFrame, candidates: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """C11 surrogate ids for new natural keys of a small dimension.

    New keys get ``max(id) + dense_rank()`` in key order, so reruns give the
    same ids. The rank window is global: use only for dimensions (bounded
    by stations^2, categories x carriers ...); fact-sized tables use
    ``hash_id``.
    """
    keys = list(keys)
    new = candidates.select(*keys).distinct().join(existing.select(*keys), keys, "left_anti")
    top = existing.select(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    w = Window.orderBy(*keys)
    new = new.withColumn(id_col, (top + F.dense_rank().over(w)).cast("bigint"))
    return existing.select(id_col, *keys).unionByName(new.select(id_col, *keys))


def hash_id(*cols) -> Column:
    """Stable 64-bit id of a natural key for large tables (run headers)."""
    return F.xxhash64(*cols)


# ---- C12 / C13 ---------------------------------------------------------------

def materialize(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """C12 complete refresh of a report snapshot; returns the stored table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_version(spark: SparkSession, root: str, tables: dict[str, DataFrame],
                  partition_by: dict[str, Sequence[str]] | None = None) -> str:
    """Write every table under a fresh version directory (not yet visible to readers)."""
    version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    vdir = f"{root}/v={version}"
    for name, df in tables.items():
        w = df.write.mode("errorifexists")
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.parquet(f"{vdir}/{name}")
    return vdir


def switch_pointer(spark: SparkSession, root: str, vdir: str, tables: Sequence[str]) -> None:
    """Make a staged version current (the pointer file is replaced last)."""
    _write_pointer(spark, root, {"version": vdir.rsplit("v=", 1)[1], "tables": sorted(tables)})


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame],
            partition_by: dict[str, Sequence[str]] | None = None) -> str:
    """C13 all-or-nothing layer publish without a transactional format.

    Every table is written under a fresh version directory; only after all
    writes succeed a new numbered pointer file is added (written to a
    temporary name, then renamed; the highest number holds). Readers resolve tables through the
    pointer, so they see either the old or the new layer, never a mix.
    A failed or re-run job leaves an unreferenced version directory.
    """
    vdir = stage_version(spark, root, tables, partition_by)
    switch_pointer(spark, root, vdir, list(tables))
    return vdir


POINTER = "_CURRENT-"


def _pointers(spark: SparkSession, root: str) -> tuple:
    """The root's file system, its path, and its pointer numbers in order; no numbers for a root that is not there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return fs, path, []
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return fs, path, sorted(int(n.removeprefix(POINTER)) for n in names if n.startswith(POINTER) and n.removeprefix(POINTER).isdigit())


def _write_pointer(spark: SparkSession, root: str, payload: dict) -> None:
    """Adds the next pointer file. No pointer is ever deleted, so a crash leaves the last one in force."""
    jvm = spark.sparkContext._jvm
    fs, _, numbers = _pointers(spark, root)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/_tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(payload).encode()))
    out.close()
    dst = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}{(numbers[-1] if numbers else 0) + 1:012d}")
    if fs.exists(dst) or not fs.rename(tmp, dst):
        raise RuntimeError(f"another publish has taken {dst.toString()}")


def published_version(spark: SparkSession, root: str) -> str | None:
    """The version that the highest pointer names; None if nothing was ever published."""
    jvm = spark.sparkContext._jvm
    fs, _, numbers = _pointers(spark, root)
    if not numbers:
        return None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}{numbers[-1]:012d}"))
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream))
    text = reader.readLine()
    reader.close()
    return json.loads(text)["version"]


def current_version(spark: SparkSession, root: str) -> str:
    version = published_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return version


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A published table: where its manifest says (``operators.layer``), else in the published version's folder."""
    from perron.operators import layer
    tables = layer.manifest(spark, root)
    if name in tables:
        return layer.read_table(spark, root, tables[name])
    return spark.read.parquet(f"{root}/v={current_version(spark, root)}/{name}")


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on a cluster)."""
    from perron.session import checkpoint_dir
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:8]}") if "://" not in base else \
        f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"
