"""Connected components of a large graph by alternating stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.base import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and all its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    out = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, is linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(least.select(F.col("u").alias("w"), "m"), F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one node below it at most, which has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return odd.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (u, v); nodes and edges may repeat.

    Large and small stars alternate, each pass written to the shared folder, until only stars are left: then every
    node is linked to the least of its component. The number of passes grows with the logarithm of the longest path.
    An empty graph has no nodes.
    """
    edges = edges.where(F.col("u") != F.col("v")).distinct()
    while True:
        edges = staged(_small_star(_large_star(edges)), "components")
        if _are_stars(edges):
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
