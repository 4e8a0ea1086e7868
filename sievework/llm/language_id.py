"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of labelled texts in Spark tasks; the table of log-probabilities,
``BUCKETS`` rows by one column a language, is broadcast (its size depends on the languages
alone). Scoring looks the n-grams of a batch up in that table and sums them by document.

Defined results: a null text, or one without letters, is ``und`` with score 0; so is every text
when nothing could be learned (empty table, no labels). Ties go to the first language by code
point. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import released, small_batches

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Labelled documents that training takes of each language, at most about; chosen by a hash of the id.
MAX_TRAIN_DOCS = 20_000
#: Characters that one numpy pass holds.
PASS_CHARS = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first, end, letters of each, text of each n-gram and its bucket."""
    at = 0
    while at < len(texts):
        chunk, size, first = [], 0, at
        while at < len(texts) and (not chunk or size + len(texts[at] or "") <= PASS_CHARS):
            chunk.append(" " + (texts[at] or "").lower() + " ")
            size += len(chunk[-1])
            at += 1
        code = np.frombuffer("".join(chunk).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(chunk)), [len(x) for x in chunk])
        letter = _letters()[code]
        n_letters = np.bincount(doc[letter], minlength=len(chunk))
        # a run of other characters counts as one space
        keep = letter.copy()
        keep[1:] |= letter[:-1] & (doc[1:] == doc[:-1])
        keep[:-1] |= letter[1:] & ~letter[:-1] & (doc[1:] == doc[:-1])
        code, doc = np.where(letter, code, 32)[keep].astype(np.uint64), doc[keep]
        twice = np.zeros(len(code), bool)
        twice[1:] = (code[1:] == 32) & (code[:-1] == 32) & (doc[1:] == doc[:-1])
        code, doc = code[~twice], doc[~twice]
        docs, buckets = [], []
        for n in ORDERS:
            m = max(0, len(code) - n + 1)
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + code[j : j + m]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            same = doc[:m] == doc[n - 1 : n - 1 + m]
            docs.append(doc[:m][same])
            buckets.append((h[same] >> np.uint64(48)).astype(np.int64))
        yield first, at, n_letters, np.concatenate(docs), np.concatenate(buckets)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages by code point and their log-probabilities, ``BUCKETS + 1`` rows; the last holds log-priors."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).where("text is not null and lang is not null")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return [], np.zeros((BUCKETS + 1, 0))
    shares = F.create_map(*[F.lit(x) for k in langs for x in (k, max_docs / totals[k])])
    rows = rows.where((F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)) < shares[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(langs), BUCKETS), np.int64)
        for b in batches:
            of = np.array([langs.index(x) for x in b.column("lang").to_pylist()], np.int64)
            for first, _, _, doc, bucket in _grams(b.column("text").to_pylist()):
                table += np.bincount(of[first + doc] * BUCKETS + bucket, minlength=table.size).reshape(table.shape)
        k, j = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(j, pa.int32()), pa.array(table[k, j])], ["k", "bucket", "n"])

    small_batches(labelled.sparkSession)
    counts = rows.select("text", "lang").mapInArrow(released(count), "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    table = np.zeros((BUCKETS, len(langs)))
    table[got["bucket"].to_numpy(), got["k"].to_numpy()] = got["n"].to_numpy()
    table = np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * BUCKETS))
    prior = np.log(np.array([totals[k] for k in langs]) / sum(totals.values()))
    return langs, np.vstack([table, prior])


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``' columns ``keep`` (default: all) with ``lang_pred`` and ``score``, the posterior of that language."""
    spark = docs.sparkSession
    small_batches(spark)
    langs, table = model
    shared = spark.sparkContext.broadcast((langs, table.astype(np.float32)))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    rows = docs.select(*keep, F.col(text).alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        logp, prior = table[:-1], table[-1].astype(np.float64)
        for b in batches:
            texts = b.column("_text").to_pylist()
            pred, best = ["und"] * len(texts), np.zeros(len(texts))
            for first, end, letters, doc, bucket in _grams(texts) if langs else ():
                sums = np.stack([np.bincount(doc, weights=logp[:, k][bucket], minlength=end - first) for k in range(len(langs))], axis=1) + prior
                top = sums.argmax(axis=1)
                p = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i in np.flatnonzero(letters):
                    pred[first + i], best[first + i] = langs[top[i]], p[i]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(pred, pa.string()), pa.array(best)], [*keep, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(released(score), f"{fields}{', ' if fields else ''}lang_pred string, score double")


def held_out(key: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false if the id is null."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, keep: list[str], max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """Learn from the rows of ``docs`` that aren't held out, then predict all of them."""
    model = train(docs.where(~held_out(F.col("doc_id"))), max_docs=max_docs)
    return predict(docs, model, keep=keep)


#: The posterior below which the pipeline rejects a document.
LEAST_SCORE = 0.5


def accepted(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language could be told: not ``und``, posterior at least ``least``."""
    told = identify(docs, keep=docs.columns)
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*docs.columns)
