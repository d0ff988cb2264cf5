"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from erpspark.llm.scratch import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every node is moved towards the smallest node it can see."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    large = stored(both.where("b > a").join(low, "a").select(F.col("low").alias("a"), "b").where("a < b").distinct(), "large-star")
    # edges now point from the smaller (a) to the larger (b); each larger node keeps its smallest and links the others to it
    least = large.groupBy("b").agg(F.min("a").alias("low"))
    linked = large.join(least, "b")
    small = linked.select(F.col("low").alias("a"), "b").unionByName(linked.where("a > low").select(F.col("low").alias("a"), F.col("a").alias("b")))
    return stored(small.distinct(), "small-star")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.count_distinct("a")).first())


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for every node of the edges (a, b).

    Steps repeat until nothing moves; then every edge goes from the smallest node of a component. Only
    counts reach the driver.
    """
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = _stars(now)
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(roots)
