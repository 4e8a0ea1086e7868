"""64-bit similarity hashes of texts and vectors, and their distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that an Arrow batch of texts should hold at most, as these can be long; it is for the caller to set while the job runs.
ARROW_ROWS = 256
#: Grams of one text whose digests are held at once.
HELD_GRAMS = 1 << 16


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def _simhash(text: str, grams: int) -> int:
    """SimHash of one text whose words are parted by single spaces; a text of fewer words is one gram."""
    words = text.split(" ")
    grams = min(grams, len(words))
    n, sums = len(words) - grams + 1, np.zeros(64, np.int64)
    for at in range(0, n, HELD_GRAMS):
        part = words[at : at + HELD_GRAMS + grams - 1]
        runs = zip(*[part[j:] for j in range(grams)], strict=False)
        firsts = b"".join([md5(" ".join(r).encode()).digest()[:8] for r in runs])
        sums += np.unpackbits(np.frombuffer(firsts, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > n).view(">i8")[0])


def text_simhash(df: DataFrame, key: str, text: str, grams: int = 3) -> DataFrame:
    """``key, hash``: SimHash of lower-cased word n-grams, each by the first 64 bits of its MD5.

    A bit is set if more than half of the grams set it. A text of fewer words is one gram, a null text is an empty one. Nothing is
    shuffled; digests and their bits are summed in tasks, since as SQL sums over exploded grams they take
    many times the processor time.
    """
    norm = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t\\n\\r]+", " "))
    rows = df.select(F.col(key).alias("_key"), norm.alias("_text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [_simhash(t.as_py(), grams) for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays([b.column("_key"), pa.array(hashes, pa.int64())], ["_key", "hash"])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(make, f"_key {kind}, hash long").withColumnRenamed("_key", key)


def sign_hash(vector: Column, reverse: bool = False) -> Column:
    """The signs of a vector's first 64 values as bits; ``reverse`` mirrors the vector."""
    v = F.reverse(vector) if reverse else vector
    bits = [F.when(F.get(v, F.lit(i)) > 0, F.shiftleft(F.lit(1).cast("long"), 63 - i)).otherwise(F.lit(0).cast("long")) for i in range(64)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)
