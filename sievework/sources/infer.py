"""Types of text columns, found by one aggregation over all rows.

A column's type is the first of ``TYPES`` that all its filled values have, else string. What is counted for
each column and type can be summed in any order, so files, partitions and their order don't matter.
Blank and null values have any type; a column of nothing else is string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What texts of each type look like.
TYPES = ("boolean", "long", "double", "date")
LONG, DOUBLE, DATE = r"^[+-]?[0-9]{1,18}$", r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _is(kind: str, v: Column) -> Column:
    return {"boolean": F.lower(v).isin("true", "false"), "long": v.rlike(LONG), "double": v.rlike(DOUBLE), "date": v.rlike(DATE) & v.try_cast("date").isNotNull()}[kind]


def column_types(rows: DataFrame) -> DataFrame:
    """``name, type, filled, blank``: a row for each column of texts."""
    if not rows.columns:
        return rows.sparkSession.createDataFrame([], "name string, type string, filled long, blank long")
    value = lambda c: F.trim(F.col(f"`{c}`"))
    filled = lambda c: F.coalesce(value(c) != "", F.lit(False))
    counts = [F.struct(F.lit(c).alias("name"), F.count_if(filled(c)).alias("filled"), F.count_if(~filled(c)).alias("blank"), *[F.count_if(filled(c) & _is(t, value(c))).alias(t) for t in TYPES]).alias(f"c{i}") for i, c in enumerate(rows.columns)]
    found = rows.agg(*counts).select(F.explode(F.array(*[f"c{i}" for i in range(len(counts))])).alias("c")).select("c.*")
    kind = F.coalesce(*[F.when((F.col("filled") > 0) & (F.col(t) == F.col("filled")), t) for t in TYPES], F.lit("string"))
    return found.select("name", kind.alias("type"), "filled", "blank")


def typed(rows: DataFrame) -> DataFrame:
    """``rows`` with each column cast to its type; blanks are null. What is collected is a row a column."""
    kinds = {r["name"]: r["type"] for r in column_types(rows).collect()}
    return rows.select(*[F.when(F.trim(F.col(f"`{c}`")) != "", F.trim(F.col(f"`{c}`")) if k != "string" else F.col(f"`{c}`")).cast(k).alias(c) for c, k in kinds.items()])
