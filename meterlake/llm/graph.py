"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import staged


def is_star_forest(edges: DataFrame) -> bool:
    """Whether every node either is the least one of its edges ``u > v`` or has one edge to such a node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the least node of its component.

    Alternating stars: in one step each node hands its larger neighbours to its least one, in the next its smaller
    ones, until only stars are left. Every step only joins nodes with their least neighbour, so hubs are never gathered,
    and is written to the shared folder. No step makes more edges than it reads, but for one per node.
    """
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(rounds):
        if is_star_forest(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staged(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = staged(small, "links")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
