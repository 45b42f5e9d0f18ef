"""Connected components by alternating star contraction, in joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import cut


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.hash("b", "a").cast("long"))).first())


def star_roots(edges: DataFrame) -> DataFrame:
    """Edges (`a`, `b`) to (`node`, `root`): the smallest node each linked node reaches.

    Each round, every node passes its smallest neighbour to its larger neighbours, then to its
    smaller ones. A node's neighbours are never collected: the minimum is a partial aggregate and
    meets them again by a join, in which a node with many neighbours can be split. Every round is
    cut off to the shared folder; the rounds grow with the logarithm of the longest path.
    """
    edges = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _signature(edges)
    while before[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(smallest, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(least, F.col("a") == F.col("u")).where("b > m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
