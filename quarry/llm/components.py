"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written first: AQE splits the neighbours of a hot node only where both
    # sides of the join come from exchanges of their own.
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    return both.where("v > u").join(least, "u").select("v", F.least("m", "u").alias("m")).where("v > m")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the least of them; ``edges`` has u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its least node.

    Node ids are longs without nulls. A self loop or a repeated edge changes
    nothing; a node of self loops alone is not returned. Every round is two
    aggregates and two joins on a node id; rounds grow with the logarithm of
    the longest path.
    """
    now = staged(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    mark = None
    while True:
        starred = _large_star(now).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(_small_star(starred), "stars")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
