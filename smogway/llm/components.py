"""Connected components of a link table by alternating large and small stars, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.sources.staging import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours of every node to its smallest one: the larger neighbours, or the smaller and itself."""
    if large:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        return edges.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ordered.groupBy("a").agg(F.min("b").alias("low"))
    others = ordered.join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(least.select("a", F.col("low").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame) -> DataFrame:
    """`node, root` for every node of the links (a, b): root is the smallest node that it is connected to.

    Each round is two joins and aggregations over at most as many rows as there are links; every round is a
    written table, so nothing is recomputed. The number of rounds grows with the logarithm of the longest path.
    """
    edges = stage(links.where("a != b").select("a", "b").distinct(), "links")
    mark = _mark(edges)
    while True:
        larger = stage(_star(edges, large=True).distinct(), "links")
        edges = stage(_star(larger, large=False).distinct(), "links")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())
