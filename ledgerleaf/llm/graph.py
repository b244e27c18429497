"""Connected components of a large graph, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, released


def _with_least(pairs: DataFrame, own: bool) -> DataFrame:
    """Each pair (u, v) with the least of u's partners, and of u if ``own``. Minima are formed before the shuffle and
    joined back, so that a node with very many partners is split between tasks."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if own:
        least = least.withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def _summary(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node that has an edge; ``edges`` has columns a and b of one type that orders. The root is
    the component's least node. Loops and repeated edges count nothing; no edges, no rows.

    Each round's pairs go to the checkpoint folder, so that a lost executor costs at most one round; the shuffle files behind
    them are let go round by round, for many small files take more room than the pairs themselves."""
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = checkpointed(pairs)
    before = _summary(pairs)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, own=True).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        found = _with_least(large, own=False)
        small = found.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
        pairs = checkpointed(small.distinct())
        del both, large, found, small  # what holds the round's shuffle files
        released(pairs.sparkSession)
        after = _summary(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components have not settled")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
