"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.sources.shared import cut, drop


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node that links reach) for the ends of ``a``-``b``.

    Large-star and small-star steps alternate until nothing changes. Each is an aggregation of
    running minima and a join, written to the shared folder: no node's links meet in one task.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = cut(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = cut(small.union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "small")
        # neither has repeated rows, so as many rows without a new one are the same rows; counts come from the files' footers
        changed = small.count() != now.count() or not small.join(now, ["a", "b"], "left_anti").isEmpty()
        drop(large, now)
        now = small
        if not changed:
            roots = now.select(F.col("b").alias("node")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
