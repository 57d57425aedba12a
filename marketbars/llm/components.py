"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.shared import saved


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step (Kiveris et al., 2014).

    The neighbours of a node are never gathered: their minimum is an aggregate
    and goes back to them in a join whose hot partitions Spark splits.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.join(least, "a").where(F.col("b") > F.col("a"))
    large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = large.where(F.col("a") != F.col("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a").where(F.col("b") != F.col("m"))
    small = small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node has an edge to one smaller node, and that has none of its own."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and the smallest node of its component, for nodes that have an edge.

    `edges` has `a` and `b`, longs. Steps are repeated until all components are
    stars around their smallest node; each is written to the shared folder, so
    that lineage stays short.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = saved(ordered.distinct())
    while not _is_forest_of_stars(current):
        current = saved(_stars(current))
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
