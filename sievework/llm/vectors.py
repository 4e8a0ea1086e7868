"""Vectors of an Arrow batch as integer matrices, and their exact sums over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one numpy pass.
BLOCK = 1024


def finite(vector: Column) -> Column:
    """Whether a vector isn't null and holds neither nulls nor values that aren't finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def with_fields(rows: DataFrame, columns: list[str], more: str) -> T.StructType:
    """The schema of some columns of ``rows`` and of ``more``; names may be any."""
    return T.StructType([T.StructField(c, rows.schema[c].dataType) for c in columns] + T.StructType.fromDDL(more).fields)


def component_limit(width: int) -> int:
    """The largest size of components whose squared distances over ``width`` of them surely fit 62 bits."""
    return int((2.0**61 / max(1, width)) ** 0.5 / 2)


def integers(column: pa.ListArray, width: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are finite, whether such a row has ``width`` components, those rows as floor(scale * x)).

    A component too large for exact 64-bit squares is an error.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.list_value_length(column).fill_null(-1), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(np.maximum(sizes, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = np.flatnonzero((sizes >= 0) & (bad[ends] == bad[ends - np.maximum(sizes, 0)]))
    wide = sizes[good] == width
    rows = good[wide]
    x = np.floor(values[(ends[rows] - width)[:, None] + np.arange(width)] * scale)
    if x.size and np.abs(x).max() > component_limit(width):
        raise ValueError(f"a component times {scale} exceeds {component_limit(width)}; its squares don't fit 64 bits")
    return good, wide, x.astype(np.int64)


def summed(rows: DataFrame, columns: list[str], width: int, add: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(counts, componentwise sums) by slot, exact. ``add`` gives (slots, integer rows) of a batch; ``shape`` is that of the slots.

    A task hands on one row a slot, so what reaches the driver is a row a slot.
    """
    n = int(np.prod(shape))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(n, np.int64), np.zeros((n, width), np.int64)
        for b in batches:
            for slots, x in add(b):
                counts += np.bincount(slots, minlength=n)
                np.add.at(sums, slots, x)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), *[pa.array(sums[used, i]) for i in range(width)]], ["slot", "n", *[f"s{i}" for i in range(width)]])

    fields = ", ".join(["slot long", "n long", *[f"s{i} long" for i in range(width)]])
    totals = rows.select(*columns).mapInArrow(part, fields).groupBy("slot").agg(F.sum("n"), *[F.sum(f"s{i}") for i in range(width)])
    counts, sums = np.zeros(n, np.int64), np.zeros((n, width), np.int64)
    for slot, c, *s in totals.collect():
        counts[slot], sums[slot] = c, s
    return counts.reshape(shape), sums.reshape(*shape, width)
