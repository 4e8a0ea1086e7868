"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.graph import components
from sievework.sources.shared import cut, drop, new_path, numbered, table

__all__ = ["components", "cut", "drop", "new_path", "numbered", "pick", "released", "small_batches", "table", "without", "words"]

#: What separates words: space and the ASCII controls from tab to carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Rows in an Arrow batch. Texts can be long, so batches stay short.
ARROW_ROWS = 256


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows that one Arrow batch hands to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def released(make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``make``, after which Arrow gives back the memory that it holds unused: the worker lives on beside later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make(batches)
        pa.default_memory_pool().release_unused()

    return run


def words(text: Column) -> Column:
    """The words of a text; none if it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


#: Ids that a broadcast holds at most; more of them are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def pick(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among ``ids``, before they are shuffled; ids are broadcast only after a count."""
    ids = ids.select(key).distinct()
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids), key, "left_semi") if few else rows


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` isn't among ``ids``; ids are broadcast only after a count."""
    ids = ids.select(key).distinct()
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, "left_anti").select(*rows.columns)
