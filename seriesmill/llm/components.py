"""Connected components by alternating stars, on tables that may be larger than any machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest of their neighbourhood: larger ones, or the rest and the node."""
    if large:
        near = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = near.join(least, "u")
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every larger node has one neighbour and no neighbour is a larger node itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("larger"), F.lit(0).alias("smaller"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    sums = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return sums.filter("larger > 1 or larger = 1 and smaller = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """From edges `a`, `b` (long): every node that has an edge, with the smallest node it can reach.

    Partial minima come before every shuffle, and hot nodes are split by AQE's skew join. The number
    of rounds grows with the logarithm of the longest path, and is 0 for plain stars; each is written down.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges = stored(edges, "edges")
    while not _settled(edges):
        edges = stored(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())


def relabel(names: DataFrame, links: DataFrame) -> DataFrame:
    """`names` (node, label) after joining the components of the ends of `links` (a, b)."""
    of = lambda side: names.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
    between = links.join(of("a"), "a").join(of("b"), "b").filter("label_a != label_b")
    merged = components(between.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("merged"))
    return stored(names.join(merged, "label", "left").select("node", F.coalesce("merged", "label").alias("label")), "names")
