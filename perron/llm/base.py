"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.session import checkpoint_dir

#: A word is a run of anything but the six ASCII white-space characters, which are what bytes.split() splits on.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again.

    It cuts the lineage and survives lost executors. Each call has a folder of its own, so that a repeated
    query never reads or overwrites another's files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of texts that go to a Python worker at once.
BATCH_BYTES = "4m"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; texts are long, so Arrow batches are bounded by BATCH_BYTES unless the session says otherwise."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, BATCH_BYTES)
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def per_text(df: DataFrame, fn: Callable[[list[bytes]], list], schema: str, keep: list[str], text: str = "text",
             make: Callable[[], Callable] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` and the columns that ``fn`` makes of a batch of texts (UTF-8, null as empty).

    ``fn`` returns one Arrow array per column of ``schema``. Texts reach Python in Arrow batches and nothing but
    the results goes back. ``make`` builds ``fn`` once a task instead.
    """
    src = small_batches(df).select(*keep, text_or_empty(text).cast("binary").alias("__text"))
    fields = df.select(*keep).schema
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make() if make else fn
        for b in batches:
            cols = f(b.column(b.num_columns - 1).to_pylist())
            names = [*b.schema.names[:-1], *[x.split()[0].strip("`") for x in _split_schema(schema)]]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=names)

    return src.mapInArrow(run, out)


def _split_schema(schema: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    return [*out, cur.strip()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
