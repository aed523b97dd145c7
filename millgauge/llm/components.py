"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; ``edges`` has long columns a and b.

    root is the smallest node reachable. Each round is written below the shared folder; the driver
    sees two numbers a round. The number of rounds grows with the logarithm of the longest path.
    """
    e = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = _digest(e)
    for _ in range(MAX_ROUNDS):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.union(lowest.select("a", "m")).distinct(), "small-star")
        now = _digest(e)
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _digest(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(20,0)))")).first())
