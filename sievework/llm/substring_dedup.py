"""Removal of words inside long passages that occur again, with FM-indexes over shards.

A window of ``WINDOW`` words has one anchor: its run of ``GRAM`` words with the smallest hash, the
last of equal ones. Equal windows have equal anchors, so windows are dealt to shards by anchor, and
neighbouring windows with one anchor travel together as a passage. Anchors that occur once
are dropped, equal passages are summed to one with a weight, and each shard builds an FM-index
of its passages, streams them through it and reports the windows whose matching statistic
reaches the window's length. Every window of a document lies in exactly one passage, so weights
count occurrences exactly. An anchor with more distinct passages than ``SHARD_PASSAGES`` (a line
that very many documents share) is extended: its passages are cut in two, windows with room after
the anchor and those with room before it, and dealt anew by the anchor with the words on that
side. This is repeated, at most until the anchor is the whole window and all its passages are
equal; so no shard grows with a group.

Copies of a whole document are one document with a weight. Windows are judged on the input.

Defined results: a null text has no words; a text shorter than the window loses none. Repeated rows
are copies of each other. Rows with a null id count and lose words like others; so does each of several texts
under one id. Very long texts are processed whole, one at a time if need be. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm import text_arrays as ta
from sievework.llm.common import cut, drop, pick, released, small_batches
from sievework.llm.fm_index import FMIndex

WINDOW = 35
GRAM = 16
#: Distinct passages that one anchor may bring to a shard.
SHARD_PASSAGES = 20_000
#: Passages that stream through an index side by side.
STREAMED = 1 << 13
#: Words that one FM-index holds, about; whole anchors only.
SHARD_WORDS = 1 << 18


def anchors_of(w: ta.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Passages in order: document, anchor hash, first window (word number in the document), windows, the anchor's place in the passage."""
    none = np.zeros(0, np.int64)
    if len(w.starts) < window:
        return none, none.view(np.uint64), none, none, none
    h = ta.gram_hashes(ta.word_hashes(w), gram)
    least, at = h, np.arange(len(h))
    span, done = window - gram + 1, 1
    while done < span:
        step = min(done, span - done)
        n = len(least) - step
        later = least[step:] <= least[:n]
        least, at = np.where(later, least[step:], least[:n]), np.where(later, at[step:], at[:n])
        done += step
    n = len(least)
    inside = np.flatnonzero(w.doc[:n] == w.doc[window - 1 : window - 1 + n])
    at = at[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (at[1:] != at[:-1]) | (w.doc[inside[1:]] != w.doc[inside[:-1]])
    first = np.flatnonzero(new)
    doc = w.doc[inside[first]]
    return doc, h[at[first]], inside[first] - w.first[doc], np.diff(np.append(first, len(inside))), at[first] - inside[first]


def _joined(text: str | None) -> bytes:
    return b" ".join((text or "").encode().split())


def _digest(joined: bytes) -> str:
    return hashlib.sha256(joined).hexdigest()


def _node() -> Column:
    """What a row's text is looked up by: its id; a hash of the text where that is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def documents_of(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, node, text_hash, n_words, sha256`` (of the words joined by one space) and ``anchors``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, flat, lens = [], [], []
            for _, texts in ta.passes(b.column("text")):
                w = ta.split(texts)
                doc, anchor, *_ = anchors_of(w, window, gram)
                sizes.append(w.counts)
                flat.append(anchor)
                lens.append(np.bincount(doc, minlength=len(texts)))
            offsets = np.zeros(b.num_rows + 1, np.int32)
            np.cumsum(np.concatenate(lens) if lens else [], out=offsets[1:])
            values = pa.array((np.concatenate(flat) if flat else np.zeros(0, np.uint64)).view(np.int64))
            shas = [_digest(_joined(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "node", "text_hash")], pa.array(np.concatenate(sizes).astype(np.int64) if sizes else [], pa.int64()), pa.array(shas, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), values)], ["doc_id", "node", "text_hash", "n_words", "sha256", "anchors"])

    rows = docs.select(F.col("doc_id").cast("long"), _node().alias("node"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(released(make), "doc_id long, node long, text_hash long, n_words long, sha256 string, anchors array<long>")


def passages_of(docs: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """``anchor, passage`` (a digest), ``sha256, begin, at`` (the anchor's first word in the passage) ``, weight, words`` for the wanted anchors of each class's document.

    ``wanted`` has ``node, sha256, weight, anchors``.
    """
    rows = pick(docs.select(_node().alias("node"), "text"), wanted.select("node"), "node").join(wanted, "node").select("text", "sha256", "weight", "anchors")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in ta.passes(b.column("text")):
                w = ta.split(texts)
                doc, anchor, begin, count, inner = anchors_of(w, window, gram)
                ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                out = []
                for i in range(len(texts)):
                    parts = _joined(texts[i].as_py()).split(b" ")
                    sha, weight = b.column("sha256")[at + i].as_py(), b.column("weight")[at + i].as_py()
                    if sha != _digest(b" ".join(parts) if parts != [b""] else b""):
                        continue  # another text under the same id
                    mine = anchor[ends[i] : ends[i + 1]]
                    asked = np.asarray(b.column("anchors")[at + i].values).view(np.uint64)
                    for j in np.flatnonzero(np.isin(mine, asked)) + ends[i]:
                        s, c = int(begin[j]), int(count[j])
                        words = b" ".join(parts[s : s + c + window - 1])
                        out.append((int(anchor[j].view(np.int64)), hashlib.blake2b(words, digest_size=16).digest(), sha, s, int(inner[j]), weight, words.decode()))
                if out:
                    kinds = [pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "passage", "sha256", "begin", "at", "weight", "words"])

    return rows.mapInArrow(released(make), "anchor long, passage binary, sha256 string, begin int, at int, weight long, words string")


def extended(passages: DataFrame, window: int, span: int, more: int) -> DataFrame:
    """The passages cut in two, with anchors of ``span + more`` words in place of ``span``.

    ``more`` is half of the words that a window has beside its anchor, rounded up: a window without room for them after the anchor has it before.
    """
    rows = passages.withColumn("_w", F.split("words", " "))
    # the first window with room after the anchor
    edge, last = F.greatest(F.lit(0), F.col("at") + (span + more - window)), F.size("_w") - window
    part = lambda start, windows, skip: F.struct(start.cast("int").alias("start"), windows.cast("int").alias("n"), skip.cast("int").alias("skip"))
    after = part(edge, last + 1 - edge, F.lit(0))
    before = part(F.lit(0), F.least(edge, last + 1), F.lit(more))
    rows = rows.withColumn("_p", F.explode(F.filter(F.array(after, before), lambda p: p["n"] > 0)))
    rows = rows.withColumn("_v", F.slice("_w", F.col("_p.start") + 1, F.col("_p.n") + window - 1)).withColumn("at", F.col("at") - F.col("_p.start") - F.col("_p.skip"))
    anchor = F.xxhash64(F.col("_p.skip"), F.array_join(F.slice("_v", F.col("at") + 1, span + more), " "))
    rows = rows.withColumns({"anchor": anchor, "words": F.array_join("_v", " "), "begin": F.col("begin") + F.col("_p.start")})
    return rows.withColumn("passage", F.unhex(F.md5(F.col("words").cast("binary")))).select(*passages.columns)


def _covered(begins: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words the windows cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + window, -1)
    return np.cumsum(edge)[:-1] > 0


def _judge(passages: list[bytes], texts: list[str], weights: list[int], window: int, depth: int) -> Iterator[tuple[bytes, list[int]]]:
    """The windows of each passage that occur twice or more in the shard: the index is built, then the passages stream through it."""
    ids: dict[str, int] = {}
    seqs = [np.array([ids.setdefault(x, len(ids) + 1) for x in t.split(" ")], np.int32) for t in texts]
    index = FMIndex(seqs, np.array(weights), depth)
    for at in range(0, len(seqs), STREAMED):
        found = index.matching(seqs[at : at + STREAMED])
        for p, statistics in zip(passages[at : at + STREAMED], found, strict=True):
            hits = np.flatnonzero(statistics >= window)
            if len(hits):
                yield p, hits.tolist()


def repeated_windows(passages: DataFrame, window: int, span: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``anchor, passage, hits`` of the distinct passages that have windows found again under the same anchor of ``span`` words.

    Anchors are dealt over partitions; a partition's anchors are indexed block by block.
    """
    depth = 2 * window - span

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*_judge(*held, window, depth), strict=True)) or [[], []]
            for x in held:
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.list_(pa.int32()))], ["passage", "hits"])

        for b in batches:
            for anchor, passage, words, weight in zip(*[b.column(c).to_pylist() for c in ("anchor", "passage", "words", "weight")], strict=True):
                if anchor != last and size >= shard_words:
                    yield flush()
                    size = 0
                last = anchor
                held[0].append(passage)
                held[1].append(words)
                held[2].append(weight)
                size += words.count(" ") + 2
        if held[0]:
            yield flush()

    rows = passages.select("anchor", "passage", "words", "weight").repartition("anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(released(find), "passage binary, hits array<int>")


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_passages: int = SHARD_PASSAGES) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, node, text_hash, n_words, sha256`` of every row; ``sha256, node, begins`` of the texts with repeated windows).

    ``begins`` lists the first words of the repeated windows.
    """
    small_batches(docs.sparkSession)
    base = cut(documents_of(docs, window, gram), "documents")
    index = base.where("size(anchors) > 0").select("node", "sha256", F.explode("anchors").alias("anchor"))
    # written, so that the join has two plain shuffles, of which a frequent anchor's part can be split
    often = cut(index.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "often")
    classes = base.where(f"n_words >= {window}").groupBy("sha256").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("weight"))
    classes = cut(classes, "classes")
    found = index.join(often, "anchor").join(classes.select("node", "sha256"), ["node", "sha256"], "left_semi")
    wanted = cut(found.groupBy("node", "sha256").agg(F.collect_set("anchor").alias("anchors")).join(classes, ["node", "sha256"]), "wanted")
    pool = cut(passages_of(docs, wanted, window, gram), "passages")
    written, spans, span = [base, often, classes, wanted, pool], [], gram
    while True:
        distinct = cut(pool.groupBy("anchor", "passage").agg(F.sum("weight").alias("weight"), F.first("words").alias("words")), "distinct")
        counted = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.sum("weight").alias("w")).where("w > 1")
        more = (window - span + 1) // 2
        # with an anchor as long as the window, passages of one anchor are equal
        few = F.col("c") <= shard_passages if more else F.lit(True)
        whole = distinct.join(counted.where(few), "anchor")
        hits = cut(repeated_windows(whole, window, span), "hits")
        spans.append(pool.select("passage", "sha256", "begin").join(hits, "passage").select("sha256", F.explode(F.transform("hits", lambda i: i + F.col("begin"))).alias("begin")))
        written += [distinct, hits]
        crowded = cut(counted.where(~few).select("anchor"), "crowded")
        written.append(crowded)
        if crowded.isEmpty():
            break
        pool = cut(extended(pool.join(crowded, "anchor", "left_semi"), window, span, more), "passages")
        written.append(pool)
        span += more
    spans = reduce(DataFrame.unionAll, spans)
    spans = spans.groupBy("sha256").agg(F.sort_array(F.collect_set("begin")).alias("begins")).join(classes.select("sha256", "node"), "sha256")
    spans = cut(spans, "spans")
    lean = cut(base.drop("anchors"), "lean")
    drop(*written)
    return lean, spans


def cut_words(docs: DataFrame, spans: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """``sha256, n_removed, kept_sha256`` and, if asked for, ``kept_text`` of the texts in ``spans``."""
    rows = pick(docs.select(_node().alias("node"), "text"), spans.select("node"), "node").join(spans, "node").select("text", "sha256", "begins")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, sha, begins in zip(b.column("text"), b.column("sha256").to_pylist(), b.column("begins"), strict=True):
                joined = _joined(text.as_py())
                if _digest(joined) != sha:
                    continue
                parts, at = joined.split(b" "), np.asarray(begins.values)
                gone = _covered(at, len(parts), window)
                kept = b" ".join([parts[i] for i in np.flatnonzero(~gone)])
                out.append((sha, int(gone.sum()), _digest(kept), kept.decode() if with_text else None))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["sha256", "n_removed", "kept_sha256", "kept_text"])

    made = rows.mapInArrow(released(make), "sha256 string, n_removed long, kept_sha256 string, kept_text string")
    return made if with_text else made.drop("kept_text").distinct()


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text`` (kept words joined by one space) and ``n_chars`` counted anew.

    Texts that lose nothing stay as they are; rows that lose all their words go.
    """
    base, spans = removals(docs, window, gram)
    begins = base.join(spans.select("sha256", "begins"), "sha256").select(F.col("node").alias("_node"), F.col("text_hash").alias("_hash"), "sha256", "begins").dropDuplicates(["_node", "_hash"])
    columns = docs.columns
    small_batches(docs.sparkSession)
    # an id's other texts have rows of their own in ``begins``, or none
    rows = docs.select(*columns, _node().alias("_key"), F.xxhash64("text").alias("_text")).join(begins, (F.col("_key") == F.col("_node")) & (F.col("_text") == F.col("_hash")), "left")
    at = columns.index("text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, texts = np.ones(b.num_rows, bool), b.column("text").to_pylist()
            for i, (sha, begins) in enumerate(zip(b.column("sha256"), b.column("begins"), strict=True)):
                if begins.is_valid:
                    joined = _joined(texts[i])
                    if _digest(joined) != sha.as_py():
                        raise ValueError("two texts under one id have equal hashes")
                    parts = joined.split(b" ")
                    texts[i] = b" ".join([parts[j] for j in np.flatnonzero(~_covered(np.asarray(begins.values), len(parts), window))]).decode()
                    keep[i] = bool(texts[i])
            arrays = [b.column(c) for c in columns]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns).filter(pa.array(keep))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = rows.select(*columns, "sha256", "begins").mapInArrow(released(make), fields)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in columns else out


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_passages: int = SHARD_PASSAGES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    base, spans = removals(docs, window, gram, shard_passages)
    less = cut_words(docs, spans, window, with_text=False)
    return base.join(less, "sha256", "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))
