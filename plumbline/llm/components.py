"""Connected components of an edge list by alternating stars, as DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its neighbourhood to its larger neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    return joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest smaller neighbour to its other smaller neighbours."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node is either a root or a leaf of exactly one root."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter("up > 1 or (up = 1 and down = 1)").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b of one orderable type).

    The root is the smallest node of the component. Self-loops and NULL ends are ignored, repeated
    edges count once, no edges give no rows. Each round shuffles the edges, never collects them,
    and is written to the shared folder, so a lost executor costs one round at most.
    """
    current = written(edges.select("a", "b").filter("a != b").distinct(), "edges")
    while not _is_forest_of_stars(current):
        following = written(_small_star(_large_star(current)), "edges")
        discard(current)
        current = following
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
