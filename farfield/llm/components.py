"""Connected components of a graph given by its edges: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that does has nodes of its own: then all is told."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).take(1)


def components(edges: DataFrame, most: int = 100) -> DataFrame:
    """id, component (the smallest id reachable) of every node with an edge. edges: a, b (longs).

    Each step hangs neighbours onto the smallest node around; minima are taken by partial aggregation and joined back,
    so a node may have any number of neighbours. Steps are written to the shared folder; their number grows with the
    logarithm of the largest component.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    for _ in range(most):
        if _stars(now):
            roots = now.select(b.alias("id")).distinct().withColumn("component", F.col("id"))
            return now.select(a.alias("id"), b.alias("component")).unionByName(roots)
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where(b > a).join(low, "a").select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        now = stored(small, "edges")
    raise RuntimeError("components did not settle")
