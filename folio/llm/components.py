"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's least neighbour, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("node")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.select(F.col("a").alias("node"), "m"), F.col("a") == F.col("node")).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either joined to one smaller node only, or to larger ones only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("up") == 1))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the least node that it reaches.

    Null ends and loops join nothing. Each round is written to the shared folder; rounds end
    when only stars are left, which takes about the logarithm of a component's width.
    """
    now = edges.where(F.col("a") != F.col("b")).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    while True:
        now = stage(_small_star(_large_star(now)), "stars")
        if _all_stars(now):
            break
    # the stars of a component: its least node, joined to all others
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
