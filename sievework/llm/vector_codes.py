"""Vector code compression: product quantization whose assignments are exact.

Components become integers; each vector is cut into equal parts, and a part is coded by its nearest
codebook entry. Scores are screened by a float32 matrix product: with ``u`` = 2^-24, a product over ``d``
components is off by at most (d + 2) u / (1 - (d + 2) u) times the product of both norms, in whatever order
it is summed, conversion of the integers included. Each entry's score so has an interval, and
every entry whose interval reaches below the least upper end is evaluated again in int64; ties go
to the lower index. Codebooks are refined by sums that tasks add up, a row an entry.

Defined results: a vector that is null or holds a null or non-finite component is dropped. The
width is that of the first kept row (by id, then vector). A kept row of another width, or any row if
the width isn't a multiple of the parts, gets a null code and error and takes part in no sum. Fewer rows than
entries make a smaller codebook. Rows that repeat an id count each; null ids come last among the
first entries. A label without errors has a null sum. An empty table gives an empty result. A component above
``vectors.component_limit`` after scaling is an error. Other columns pass if they are asked for; those named
like results give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import cut
from sievework.llm.vectors import BLOCK, finite, integers, summed, with_fields

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Half the distance between 1 and the next float32.
UNIT = 2.0**-24
#: More labels than this are joined by a shuffle.
BROADCAST_LABELS = 1 << 16
RESULTS = ["code", "error", "label_error", "codebooks_sha256"]


class Codebook:
    """The entries of one part. Of equal entries only the first can be nearest, so the others aren't screened."""

    def __init__(self, entries: np.ndarray) -> None:
        _, first = np.unique(entries, axis=0, return_index=True)
        self.index = np.sort(first)
        self.exact = entries[self.index]
        self.single = self.exact.astype(np.float32)
        self.squares = (self.exact.astype(np.float64) ** 2).sum(1)
        self.norms = np.sqrt(self.squares)

    def screen(self, x: np.ndarray) -> np.ndarray:
        """Which entries can be nearest to which rows: intervals of |c|^2 - 2xc that overlap the best."""
        d = x.shape[1]
        middle = self.squares - 2.0 * (x.astype(np.float32) @ self.single.T).astype(np.float64)
        sizes = np.sqrt((x.astype(np.float64) ** 2).sum(1))[:, None] * self.norms
        off = 2 * (d + 2) * UNIT / (1 - (d + 2) * UNIT) * sizes
        # what the doubles of this very estimate are off, generously
        off = (off + 2.0**-48 * (self.squares + 2 * sizes)) * (1 + 2.0**-20)
        return middle - off <= (middle + off).min(axis=1, keepdims=True)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        found, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for at in range(0, len(x), BLOCK):
            block = x[at : at + BLOCK]
            rows, cols = np.nonzero(self.screen(block))
            exact = ((block[rows] - self.exact[cols]) ** 2).sum(1)
            best = np.minimum.reduceat(exact, np.searchsorted(rows, np.arange(len(block))))
            ties = np.flatnonzero(exact == best[rows])
            firsts = ties[np.unique(rows[ties], return_index=True)[1]]
            found[at : at + BLOCK], distance[at : at + BLOCK] = self.index[cols[firsts]], best
        return found, distance


def train(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks as integers by part, entry and place; None if no row has a width to be cut into parts."""
    kept = vectors.select(F.col(key).alias("_k"), F.col(column).alias("_v")).where(finite(F.col("_v")))
    order = [F.col("_k").asc_nulls_last(), "_v"]
    first = kept.orderBy(*order).limit(1).collect()
    width = len(first[0]["_v"]) if first else 0
    if not width or width % parts:
        return None
    d = width // parts
    first = kept.where(F.size("_v") == width).orderBy(*order).limit(entries).collect()
    books = np.floor(np.array([r["_v"] for r in first], np.float64) * scale).astype(np.int64).reshape(-1, parts, d).transpose(1, 0, 2)
    k = books.shape[1]
    for _ in range(rounds):
        now = books

        def add(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            _, _, x = integers(b.column("_v"), width, scale)
            for p in range(parts):
                part = x[:, p * d : (p + 1) * d]
                yield p * k + Codebook(now[p]).nearest(part)[0], part

        counts, sums = summed(vectors.select(F.col(column).alias("_v")), ["_v"], d, add, (parts, k))
        books = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], now)
    return books


def encode(vectors: DataFrame, books: np.ndarray | None, keep: list[str], column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``keep``, ``code`` (indexes in part order, two hex digits each) and ``error`` (squared distances summed over parts)."""
    keep = [c for c in keep if c not in RESULTS]
    rows = vectors.select(F.struct(*keep).alias("_row") if keep else F.lit(0).alias("_row"), F.col(column).alias("_v"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [] if books is None else [Codebook(b) for b in books]
        width = 0 if books is None else books.shape[0] * books.shape[2]
        for b in batches:
            good, wide, x = integers(b.column("_v"), width, scale)
            code, error = np.full(len(good), None, object), np.zeros(len(good), np.int64)
            if own:
                found = [o.nearest(part) for o, part in zip(own, np.split(x, len(own), axis=1), strict=True)]
                digits = np.stack([f for f, _ in found], axis=1)
                code[wide] = ["".join(f"{i:02x}" for i in r) for r in digits.tolist()]
                error[wide] = sum(e for _, e in found)
            known = wide & bool(own)
            yield pa.RecordBatch.from_arrays([b.column("_row").take(pa.array(good)), pa.array(code, pa.string()), pa.array(error, pa.int64(), mask=~known)], ["_row", "code", "error"])

    out = rows.mapInArrow(make, with_fields(rows, ["_row"], "code string, error long"))
    return out.select(*(["_row.*"] if keep else []), "code", "error")


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``approximation``: the coded vector's integers over ``scale``; null for a null code."""
    table = F.array(*[F.array(*[F.array(*[F.lit(int(v)) for v in e]) for e in b]) for b in books])
    at = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    whole = F.concat(*[F.get(F.get(table, F.lit(p)), at(p)) for p in range(len(books))])
    return codes.withColumn("approximation", F.when(F.col("code").isNotNull(), F.transform(whole, lambda v: v / F.lit(float(scale)))))


def codebooks_digest(books: np.ndarray | None) -> str:
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, keep: list[str], label: str = "label", key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``keep``, ``code``, ``error``, ``label_error`` (errors summed over equal labels, nulls together) and ``codebooks_sha256``."""
    books = train(vectors, key, column)
    named = vectors.withColumn("_label", F.col(label))
    coded = cut(encode(named, books, [*keep, "_label"], column), "codes")
    sums = cut(coded.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_l"), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    out = coded.join(sums, F.col("_label").eqNullSafe(F.col("_l")))
    return out.select(*[c for c in keep if c not in RESULTS], "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
