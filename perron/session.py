"""Spark session defaults and shared-storage helpers.

Every job takes an existing session; ``get_spark`` is only a convenience for
tests, the bench and local runs. Cluster settings (shuffle partitions, file
split size, checkpoint dir) are read from the session when present and only
filled in where unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for local[N]; on a cluster the submitter's values win.
_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": os.environ.get("PERRON_AQE_COALESCE", "true"),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "perron") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    b = b.config("spark.driver.memory", os.environ.get("PERRON_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage; without it this fails.
    Local runs that leave it unset get one fresh scratch folder a session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        d = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="perron-ckpt-")
        _LOCAL[spark.sparkContext.applicationId] = d
    spark.sparkContext.setCheckpointDir(d)
    return d


#: Folders made for local sessions without spark.checkpoint.dir, by application.
_LOCAL: dict[str, str] = {}


#: Bytes of Parquet input for each shuffle partition: decoded, a few times as much, they fit a task's memory with their sort.
PARTITION_BYTES = 4 << 20

#: Bytes of stored files for a scan task: a minimum over structs sorts its task's rows, some ten times as much decoded, before the shuffle.
SCAN_BYTES = 16 << 20


def size_shuffles(spark: SparkSession, paths: list[str]) -> None:
    """Raises ``spark.sql.shuffle.partitions`` to one for every 4 MB of the inputs; a higher value of the submitter stays.

    With a fixed number the partitions grow with the input until their sorts spill. Scan tasks, which grow up to
    ``spark.sql.files.maxPartitionBytes``, get at most 16 MB where the submitter leaves it unset.
    """
    if spark.conf.get("spark.sql.files.maxPartitionBytes", None) is None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
    conf, n = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for path in map(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, paths):
        fs = path.getFileSystem(conf)
        n += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    if n // PARTITION_BYTES > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(n // PARTITION_BYTES))


#: Codec of what a job writes for itself to read again: documents and parsed documents take about half the bytes of the default.
SCRATCH_CODEC = "zstd"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder (not created yet), so that a repeated run meets no other's files."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
