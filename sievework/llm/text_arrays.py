"""Words and their hashes for a batch of texts, as numpy arrays over the UTF-8 bytes.

White space is ASCII, and UTF-8 keeps ASCII bytes out of longer characters, so splitting bytes
splits characters. All functions take whole texts; batches are cut between documents only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that one numpy pass holds; one longer document makes a pass of its own.
PASS_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of documents ``0 .. n_docs-1`` in order: byte spans, document of each, first word of each document."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def passes(column: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column with about ``limit`` bytes each, with their first row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.binary_length(column).fill_null(0))
    at = 0
    while at < len(column):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, side="right")))
        yield at, column.slice(at, n)
        at += n


def split(column: pa.Array, lower: bool = False) -> Words:
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[data] if lower else data
    gap = _GAP[data]
    begins, stops = ~gap, ~gap
    begins[1:] &= gap[:-1]
    stops[:-1] &= gap[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = ~gap[inner]
    stops[inner - 1] = ~gap[inner - 1]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.repeat(np.arange(len(column)), np.diff(first)), first)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes: differences of prefix sums, brought to a common place."""
    n = len(w.data) + 1
    up, down = _powers(max(PASS_BYTES * 2, 1 << (n - 1).bit_length()))
    sums = np.zeros(n, np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * up[: n - 1], out=sums[1:])
    return mix((sums[w.ends] - sums[w.starts]) * down[w.starts] + (w.ends - w.starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each run of ``n`` words, by the place of its first word; runs may cross documents."""
    m = max(0, len(h) - n + 1)
    out = np.full(m, n, np.uint64)
    for j in range(n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + h[j : j + m])
    return out


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each document's distinct n-word shingles, sorted by both.

    A document of fewer words has its whole sequence as its one shingle; one of none has none.
    """
    h, counts = word_hashes(w), w.counts
    grams = gram_hashes(h, n)
    whole = w.doc[: len(grams)] == w.doc[n - 1 :] if len(grams) else np.zeros(0, bool)
    docs, hashes = [w.doc[: len(grams)][whole]], [grams[whole]]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            out = np.full(len(short), k, np.uint64)
            for j in range(k):
                out = mix(out * np.uint64(0x9FB21C651E98DF25) + h[w.first[short] + j])
            docs.append(short)
            hashes.append(out)
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]
