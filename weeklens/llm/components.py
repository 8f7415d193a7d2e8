"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of the neighbourhood."""
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.filter("u > v").unionAll(least.select("u", F.col("m").alias("v")))


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: any orderable type, not null); root is the
    smallest node that can be reached. Self links are ignored unless a node has no other link.

    Each round is two grouped minima with map-side combine and two equi-joins, written to the
    checkpoint folder; the rounds grow with the logarithm of the longest chain. The state is one
    row per remaining link, never gathered on the driver: only a fingerprint of the table (its
    count and the sum of its row hashes) decides when it has stopped changing.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    loops = e.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("root"))
    e = cut(e.filter("u > v").distinct())
    mark = _mark(e)
    for _ in range(max_rounds):
        e = cut(_small_star(_large_star(e)).distinct())
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(roots).unionAll(loops).groupBy("node").agg(F.min("root").alias("root"))
