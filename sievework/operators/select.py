"""Selecting labels and topping up those with too few items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def selected(df: DataFrame, label: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the named labels, the others)."""
    known = F.coalesce(F.col(label).isin(names), F.lit(False))
    return df.where(known), df.where(~known)


def top_up(df: DataFrame, label: str, order: str, role: str, floor: int) -> DataFrame:
    """New rows ``label, i, source, variant`` that bring each label to ``floor``.

    New row i comes from source i mod m, variant i div m + 1, of the label's m unique rows in
    order, or of all its rows if none is unique. At most ``floor`` sources of a label are numbered.
    """
    unique = F.col(role) == "unique"
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if(unique).alias("u")).where(F.col("n") < floor)
    pool = df.join(per, label).where((F.col("u") == 0) | unique)
    # only labels below the floor are here, so a label has fewer rows than the floor
    place = F.row_number().over(Window.partitionBy(label).orderBy(order)) - 1
    pool = pool.select(label, F.col(order).alias("source"), place.alias("_at"))
    wanted = per.select(label, F.when(F.col("u") > 0, F.col("u")).otherwise(F.col("n")).alias("m"), F.explode(F.sequence(F.lit(0), F.lit(floor) - F.col("n") - 1)).alias("i"))
    wanted = wanted.select(label, "i", F.pmod("i", "m").alias("_at"), (F.floor(F.col("i") / F.col("m")) + 1).cast("long").alias("variant"))
    return wanted.join(pool, [label, "_at"]).select(label, F.col("i").cast("long").alias("i"), "source", "variant")


def counts(df: DataFrame, label: str, names: list[str]) -> DataFrame:
    """Rows of each selected label, 0 included, and a total (null label)."""
    known = df.sparkSession.createDataFrame([(n,) for n in names], f"{label} string")
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return known.join(per, label, "left").rollup(label).agg(F.sum(F.coalesce("_n", F.lit(0))).alias("n"))
