"""Joins on keys that may be null (a null key is a key like others), and how a table is joined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows that a broadcast holds at most, of a table that was counted.
BROADCAST_ROWS = 1 << 18


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join by a shuffle.

    Spark takes the size of compressed files for that of their rows, and the size before an explode for that
    after it, so it would broadcast tables that are many times larger than it believes.
    """
    return df.hint("merge")


def counted(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df`` for a join: broadcast if it has few rows, by a shuffle otherwise."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if most is None else most) else shuffled(df)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` and ``right`` joined where all ``keys`` are equal or null alike; the keys stand once."""
    named = {k: f"_right_{k}" for k in keys}
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in named.items()])
    right = right.withColumnsRenamed(named)
    if how in ("left_semi", "left_anti"):
        return left.join(right, on, how)
    if how != "full":
        return left.join(right, on, how).drop(*named.values())
    # of a row that only the right side has, the keys are there
    met = left.withColumn("_of_left", F.lit(True)).join(right, on, how)
    return met.withColumns({k: F.when(F.col("_of_left"), F.col(k)).otherwise(F.col(r)) for k, r in named.items()}).drop("_of_left", *named.values())
