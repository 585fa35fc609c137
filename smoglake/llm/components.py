"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component is the least node.

    Each half round takes one minimum per node (combined before the shuffle)
    and joins it back to the edges, so a node with many edges is never
    gathered in one task: the join splits it. Every round is written to the
    shared folder, which cuts the lineage, until all that is left are stars.
    """
    current = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), name)
    while not _are_stars(current):
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour moves to the least one around
        large = (both.filter("b > a").join(least, "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: the node and its smaller neighbours move to the least one
        large = staged(large, name)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        current = staged(small, name)
    pairs = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which itself has none."""
    twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    chained = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return twice.unionByName(chained).isEmpty()
