"""Connected components of a graph given as a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(pairs: DataFrame, small: bool) -> DataFrame:
    """pairs (u, v) hold both directions for the large star, u > v for the small star."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = pairs.join(least, "u")
    if small:
        own = least.filter("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))
        moved = joined.filter("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return own.union(moved).distinct()
    return joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for all nodes of edges (a, b: long). Loops and repeats don't matter;
    edges with a null end are left out; no edges give no nodes.

    Rounds go on until nothing changes, which stars of this kind reach in a logarithmic number of them. Each round is written to the shared folder; a lost executor costs at most the round at work."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        large = _stars(both, small=False)
        edges = written(_stars(large.select(F.col("a").alias("u"), F.col("b").alias("v")), small=True), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 24))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        mark = now
