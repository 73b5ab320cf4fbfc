"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the least of u and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    ties = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return ties.filter("u <> v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """``edges``: u, v (long). Returns node, component (the least node of its
    component) for every node that has an edge and isn't the least one. The
    rounds grow with the logarithm of the longest path; each is written, and
    grouped minima are combined map-side, so a node may have any number of
    neighbours. Nulls must not occur; loops and repeated edges don't matter."""
    now = stored(edges.select("u", "v").filter("u <> v").distinct(), name)
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    before = None
    while True:
        state = now.agg(mark.alias("s")).first()["s"]
        if state["n"] == 0 or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        now = stored(_small_star(_large_star(now)), name)
