"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges`` (a, b).

    Alternating large-star and small-star steps: each connects the neighbours of a node to
    the smallest of them, first the larger ones, then the others. The number of rounds grows
    with the logarithm of the longest path, no step makes more rows than it reads twice over,
    and minima are merged before their shuffle, so one node may have any number of links.
    """
    links = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = None
    while before != (now := _summary(links)):
        before, links = now, store(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _summary(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()
