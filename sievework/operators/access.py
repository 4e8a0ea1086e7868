"""Items by position: a written index of which a batch of positions reads only its own files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.shared import numbered

#: Items of one file, and so what a lookup of one item has to look through, less what row groups leave out.
PER_FILE = 1 << 16


def subset(items: DataFrame, split: str | None = None, client: int | None = None) -> DataFrame:
    """Items of a split and a client, as far as there are such columns; splits are compared in lower case."""
    if split is not None and "split" in items.columns:
        items = items.where(F.lower("split") == split.lower())
    if client is not None and "client_id" in items.columns:
        items = items.where(F.col("client_id") == client)
    return items


def write_index(items: DataFrame, order: list[str], path: str, per_file: int = PER_FILE) -> None:
    """Number ``items`` from 0 in ``order`` and write them to folders of ``per_file`` positions each, sorted.

    ``order`` must be total. Only sizes of ranges are summed in one place. An empty table gives an empty index.
    Columns ``index`` and ``part`` give way.
    """
    rows = numbered(items.drop("index", "part"), order, "index")
    rows = rows.withColumn("part", F.floor(F.col("index") / per_file))
    rows.repartition("part").sortWithinPartitions("part", "index").write.partitionBy("part").parquet(f"{path}/items")
    rows.sparkSession.createDataFrame([(per_file,)], "per_file long").write.parquet(f"{path}/layout")


def _open(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    per_file = spark.read.parquet(f"{path}/layout").first()["per_file"]
    try:
        return spark.read.parquet(f"{path}/items"), per_file
    except Exception as e:  # an index of nothing has no files
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None, per_file


def items_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """The items at a batch of positions; those that aren't there have no row, one asked for twice has one. Other folders aren't read."""
    items, per_file = _open(spark, path)
    if items is None:
        return spark.createDataFrame([], "index long")
    wanted = sorted(set(positions))
    return items.where(F.col("part").isin(sorted({p // per_file for p in wanted})) & F.col("index").isin(wanted)).drop("part")


def items_of(spark: SparkSession, path: str, positions: DataFrame, position: str = "index") -> DataFrame:
    """``positions`` with the items there: folders that no position falls into are pruned while the join runs."""
    items, per_file = _open(spark, path)
    asked = positions.withColumns({"_part": F.floor(F.col(position) / per_file), "_index": F.col(position)})
    if items is None:
        return asked.where("false").drop("_part", "_index")
    met = asked.join(items.withColumnRenamed("index", "_at"), (F.col("_part") == F.col("part")) & (F.col("_index") == F.col("_at")))
    return met.drop("_part", "_index", "_at", "part")
