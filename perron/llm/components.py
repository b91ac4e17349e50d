"""Connected components of an edge list, by alternating stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.base import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node of ``edges`` (a, b), long ids.

    Each round links the larger neighbours of a node, then the smaller, to the smallest one around, until the edges
    are stars. A round's minima are pre-aggregated, so a hub with most edges is no hot spot; no component is
    collected anywhere.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        before = e.agg(F.count("*"), F.sum("v")).first()
        # large star: what lies above u goes to the least of u and its neighbours
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and what lies below go to the least neighbour
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        near = e.join(low, "u")
        e = stored(near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        if e.agg(F.count("*"), F.sum("v")).first() == before and not e.join(e.select(F.col("u").alias("v")), "v", "left_semi").take(1):
            break
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
