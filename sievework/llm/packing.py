"""Packing by power-of-two decomposition.

A document's tokens (with the end token) are cut into pieces whose lengths are powers of two:
as many of the full length as fit, then the binary digits of the rest, largest first. Pieces of
one length form a bucket; each piece is a sequence of its own, so no sequence crosses documents
and none needs padding.

Defined results: a null or empty text is the end token alone. Repeated rows are packed each for
itself. Very long texts are cut as any other, white space of any length included. The
vocabulary's special token in a text is one id, as the tokenizer has it by default. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import ARROW_ROWS, cut, drop, numbered, released
from sievework.sources.shared import arrow_rows

MAX_LENGTH = 1024
END_ID = 0
#: Code points of words that an encoder remembers, those that it keeps when they are too many or a task ends, and words that it takes at once.
STORED, KEPT, AT_ONCE = 1 << 23, 1 << 21, 1 << 16
#: A space between two printed characters: the split pattern always starts a word with it, whatever stands around.
_CUT = re.compile(r" (?<=[\w!-~] )(?=[\w!-~])")
#: Letters and marks that the split pattern parts everywhere: a run of letters (the first with the space before it), a run of marks, a line's end before a letter.
_LETTERS, _MARKS = "A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF", ",.!?;:*%$&#"
_PLAIN = re.compile(f"[{_LETTERS}]+[{_MARKS}]*(?:\n[{_LETTERS}]+[{_MARKS}]*)*")
_RUNS = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+|\n")


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, by the given tokenizer.

    Texts are cut where the tokenizer cuts in any case, so ids of the parts are ids of the text. Parts
    that were met before are taken from a store; when it is full, those that it met first are kept, most of which are frequent.
    """

    def __init__(self, path: str, stored: int = STORED, at_once: int = AT_ONCE):
        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.store, self.size, self.stored, self.at_once = {}, 0, stored, at_once
        self.model = self.tokenizer.model
        # what the tokenizer's own first step makes of each character that ``_PLAIN`` knows
        known = [c for c in map(chr, range(256)) if c in " \n" or re.match(f"[{_LETTERS}{_MARKS}]", c)]
        self.bytes = str.maketrans({c: "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in known})
        self.short = lru_cache(1 << 12)(self._run)

    def _ids(self, parts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        """Ids of a run that the tokenizer would not part, by its model."""
        return _packed([t.id for t in self.model.tokenize(run.translate(self.bytes))])

    def _learn(self, new: set[str]) -> None:
        plain = [w for w in new if _PLAIN.fullmatch(w)]
        other = list(new.difference(plain))
        self.store.update(zip(other, self._ids([" " + w for w in other]), strict=True))
        for w in plain:
            head, *rest = _RUNS.findall(w)
            ids = self.store.get(head) or self._run(" " + head)
            self.store[w] = ids + b"".join(map(self.short, rest)) if rest else ids
        self.size += sum(map(len, new))

    def trim(self, most: int) -> None:
        """Keep the words that were met first, of at most so many code points."""
        if self.size <= most:
            return
        kept, size = {}, 0
        for w, ids in self.store.items():
            if size + len(w) > most:
                break
            kept[w] = ids
            size += len(w)
        self.store, self.size = kept, size

    def __call__(self, text: str) -> bytes:
        first, *rest = _CUT.split(text)
        out = self._ids([first])
        for at in range(0, len(rest), self.at_once):
            words = rest[at : at + self.at_once]
            found = list(map(self.store.get, words))
            if None in found:
                gaps = [i for i, ids in enumerate(found) if ids is None]
                self._learn({words[i] for i in gaps})
                for i in gaps:
                    found[i] = self.store[words[i]]
                if self.size > self.stored:
                    self.trim(min(KEPT, self.stored // 2))
            out += found
        return b"".join(out)


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def default_vocabulary() -> str:
    """Path of the tokenizer whose ids count."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two that sum to ``n``, none above ``longest`` (itself a power of two)."""
    out = [longest] * (n // longest)
    rest = n % longest
    return out + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pieces(docs: DataFrame, vocabulary: str | None = None, longest: int = MAX_LENGTH, with_ids: bool = True) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``."""
    path = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), _packed([END_ID])
        for b in batches:
            keys, out = b.column("doc_id").to_pylist(), []
            for key, text in zip(keys, b.column("text"), strict=True):
                ids = encoder(text.as_py() or "") + end
                at, total = 0, len(ids) // 4
                for n in piece_lengths(total, longest):
                    part = ids[4 * at : 4 * (at + n)]
                    out.append((key, at, n, zlib.crc32(part), total, part if with_ids else None))
                    at += n
            cols = list(zip(*out, strict=True)) or [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + ([pa.array(cols[5], pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])
        # the worker goes on to tasks of other kinds
        encoder.trim(KEPT)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(encode), schema)


def pack(docs: DataFrame, vocabulary: str | None = None, longest: int = MAX_LENGTH, with_ids: bool = True) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; sequences are numbered bucket by bucket, longest first.

    ``ids`` (if asked for) holds the piece's ids as little-endian unsigned 32-bit integers.
    """
    # written once: dealing rows by range reads them twice
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        written = cut(pieces(docs, vocabulary, longest, with_ids), "pieces")
    out = numbered(written.withColumn("_bucket", -F.col("length")), ["_bucket", "doc_id", "start", "ids_crc32"], "sequence_id")
    drop(written)
    return out.drop("_bucket").withColumn("offset", F.lit(0).cast("long"))
