"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a > b): every node's neighbours go to the smallest node in its reach.

    The minimum is a grouped aggregate that combines before its shuffle; the join back to the edges is an equi-join
    whose hot partitions adaptive execution can split.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = around.join(least, "a")
    if large:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component = its smallest node) for every node of ``edges`` (a, b); the order of a and b is free.

    Each round is a written table in the shared folder. Rounds grow with the logarithm of the largest component.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        now = staged(_star(_star(now, True), False), "stars")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
