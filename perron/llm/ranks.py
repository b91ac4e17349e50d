"""Places in a global order, without a window over a whole group.

Rows are dealt out by ranges of the order, so that a group of any size lies in as many ranges as it fills; places count
on from range to range by prefix sums of the ranges' counts. The dealt rows are written before anything reads a place,
so places stay when tasks or executors are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.llm.base import shuffle_partitions, stored


def ranked(df: DataFrame, group: list[str], order: list[Column | str], rank: str = "rank", size: str = "size",
           ranges: int | None = None) -> DataFrame:
    """``df`` with ``rank``: a row's place (long, from 0) among the rows of its group in the given order, and the group's ``size``.

    Nulls come first and form a group of their own; rows equal in all of ``order`` take their places in any order, which
    stays once written. ``part__`` is the range that a row was dealt to: parts follow the order of (group, order), and a
    part's rows of one group have places without gaps. ``df`` must not have these names; an empty table has no places.
    """
    keys = [F.col(g).asc_nulls_first() for g in group]
    order = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    # a column of chance splits rows that are equal in all else
    tie = F.xxhash64(F.monotonically_increasing_id())
    dealt = df.withColumn("tie__", tie)
    dealt = stored(dealt, "unranked").repartitionByRange(ranges or shuffle_partitions(df.sparkSession), *keys, *order, "tie__")
    dealt = stored(dealt.withColumn("part__", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy(*group, "part__").agg(F.count("*").alias("n__"))
    # a row for each range that a group has; ranges are as many as the caller or the session says
    whole = Window.partitionBy(*group)
    before = whole.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(g).alias(f"{g}__g") for g in group], F.col("part__").alias("p__"), F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("from__"), F.sum("n__").over(whole).alias(size))
    inside = Window.partitionBy(*group, "part__").orderBy(*order, "tie__")
    placed = dealt.withColumn("in__", F.row_number().over(inside) - 1)
    same = F.col("part__") == F.col("p__")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"{g}__g"))
    return placed.join(sizes, same).select(*df.columns, "part__", (F.col("from__") + F.col("in__")).cast("long").alias(rank), size)
