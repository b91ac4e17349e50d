"""Join operators: version-at-date lookup.

No broadcast hint is set anywhere: Spark broadcasts a side whose size in bytes is known to lie under
``spark.sql.autoBroadcastJoinThreshold``, and AQE does so at run time for a side that turns out that small; beyond it
a shuffle join is planned, whose hot partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_END = "2999-12-31"


def version_at_date(facts: DataFrame, versions: DataFrame, keys: Sequence[str], date_col: str,
                    out_prefix: str = "tt_", open_end: str = OPEN_END) -> DataFrame:
    """Attach the dimension version valid at ``date_col``, else the open one.

    Two left joins on the equi key (the range test is a residual filter of
    an equi join, never a nested loop): the version whose
    ``valid_from..valid_to`` holds the date, and the current version
    (``valid_to = open_end``); attributes are coalesced. The dimension
    must not hold overlapping versions (checked by tests).
    """
    vcols = [c for c in versions.columns if c not in keys]
    v = versions
    m = v.select(*[F.col(k).alias(f"_m_{k}") for k in keys], *[F.col(c).alias(f"_m_{c}") for c in vcols])
    c = (v.filter(F.col("valid_to") == F.lit(open_end).cast("date"))
         .select(*[F.col(k).alias(f"_c_{k}") for k in keys], *[F.col(c).alias(f"_c_{c}") for c in vcols]))
    d = F.col(date_col)
    cond_m = [F.col(k) == F.col(f"_m_{k}") for k in keys]
    cond_m += [d >= F.col("_m_valid_from"), d <= F.col("_m_valid_to")]
    cond_c = [F.col(k) == F.col(f"_c_{k}") for k in keys]
    out = facts.join(m, cond_m, "left").join(c, cond_c, "left")
    found = F.col("_m_valid_from").isNotNull()
    sel = [F.when(found, F.col(f"_m_{x}")).otherwise(F.col(f"_c_{x}")).alias(out_prefix + x) for x in vcols]
    drop = [f"_m_{x}" for x in list(keys) + vcols] + [f"_c_{x}" for x in list(keys) + vcols]
    return out.select("*", *sel).drop(*drop)
