"""Version directories ``<root>/v=<id>``, the unit of the live stream's writes.

A batch writes versions of its own id only (a replay overwrites them) and reads versions below it, so a batch that runs
again starts from what its first run read. A version counts once its ``_SUCCESS`` marker is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perron.session import SCRATCH_CODEC


def version_ids(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Ids of the complete versions under ``root``, below ``before`` if given, rising."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(root)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(root))]
    ids = [int(n[2:]) for n in names if n.startswith("v=") and fs.exists(path(f"{root}/{n}/_SUCCESS"))]
    return sorted(i for i in ids if before is None or i < before)


def write_version(df: DataFrame, root: str, version: int, by: list[str] | None = None) -> DataFrame:
    """``df`` written as a version and read again; empty tables keep their columns."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", SCRATCH_CODEC)
    (w.partitionBy(*by) if by else w).parquet(f"{root}/v={version}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/v={version}")


def read_versions(spark: SparkSession, root: str, before: int | None = None, schema=None) -> DataFrame | None:
    """All complete versions as one table (without the version itself), or None."""
    ids = version_ids(spark, root, before)
    if not ids:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", root).parquet(*[f"{root}/v={i}" for i in ids]).drop("v")
