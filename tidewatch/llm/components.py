"""Connected components by alternating star contraction, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; a component's name is its smallest node.

    A round joins each edge with the smallest neighbour of one end, so its cost follows the edges; the number of
    rounds follows the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = save(spark, edges, "edges")
    before, now = None, _state(edges)
    while now != before:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(roots, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = save(spark, small.union(roots.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, now = now, _state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b"), F.col("b")).distinct())
