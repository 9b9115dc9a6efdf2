"""Connected components of an edge table, wholly on the executors: large-star and small-star rounds until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from galeframe.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """`edges` staged, and their number and a hash of them all, seen while they were written."""
    seen = Observation()
    out = staged(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges")
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of `edges` (a, b); loops and repeated edges do no harm."""
    now, state = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = (0, None)
    while state[0] and state != before:
        before = state
        now, state = _written(_small_star(_large_star(now)))
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
