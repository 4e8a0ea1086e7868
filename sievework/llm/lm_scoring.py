"""Language-model scoring by masked pseudo-likelihood.

A small network predicts each token of a text from the ``SIDE`` tokens on either side of it; the
summed conditional log-probabilities score the document. Tokens are lower-cased words, coded as
``DIGITS`` digits: the corpus' frequent words have codes of their own, the others
share codes by hash. The network embeds the context, has one hidden layer and predicts each
digit given those before it, so its probabilities over all codes sum to 1.
A word that shares its code has the code's probability times its share of the code's occurrences in training;
all words that training hasn't seen count there as one occurrence, of which each has a part as if there were as many as seen ones.
The counts are a written table that grows with the corpus and is joined to the scored texts' words. Where the scored documents
are those of the corpus, a document's own occurrences don't count for it.

Word counts and training cover all documents: hashes deal the documents of a round into parts, whose number follows from the
corpus' words alone. Each part trains a copy of the network in numpy, in the order of the hashes, and the
copies are averaged by the positions they saw. Each document is trained on, at all its positions, in exactly one
round. Sums are taken in integers, so neither their order nor Spark's partitions matter to the network; a score can differ
by the rounding of single precision (about 1e-7 of it), since a matrix product rounds by a position's place in its block.

Defined results: a text without words, or null, has 0 tokens, log-likelihood 0 and a null
perplexity and mean. Repeated rows get equal scores up to that rounding. Very long texts are scored whole. With an empty table the
result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import text_arrays as ta
from sievework.llm.common import cut, small_batches

#: Digits of a code and the bits of each.
DIGITS, BITS = 3, 4
BASE = 1 << BITS
CODES = BASE**DIGITS
#: Codes of frequent words; the rest is shared by hash.
FREQUENT = 3072
SIDE = 2
EMBED, HIDDEN = 8, 16
#: Rounds of averaging, over which the documents are dealt.
ROUNDS = 2
#: Words of a part, whose copy is trained in one task, as long as a round has at most ``PARTS`` of them; beyond that parts grow.
PART_WORDS, PARTS = 1 << 20, 4096
BATCH, RATE = 1024, 1.0
#: Steps of the embeddings, each of which few positions of a batch move, are longer by this.
EMBED_RATE = 16.0
UNIT = float(1 << 24)
#: Positions that are scored at once; more would not stay in the cache.
SCORED = 2048
#: Words that a task gathers before it counts them.
GATHERED = 1 << 21
Params = dict[str, np.ndarray]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (a hash) and ``n``, of all words of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            word, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(c.astype(np.int64))], ["word", "n"])

        for b in batches:
            for _, texts in ta.passes(b.column("text")):
                held.append(ta.word_hashes(ta.split(texts, lower=True)))
                size += len(held[-1])
                if size >= GATHERED:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return cut(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def frequent_words(counts: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """Hashes of up to ``most`` words by count, most frequent first; none of them stands once only."""
    counts = counts.where("n > 1")
    # the least step of the counts above which there are not too many
    step = F.floor(F.log2("n") * 16)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("c")).collect()
    total, least = 0, None
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["c"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.uint64)
    top = counts.where(step >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return top["word"].to_numpy().view(np.uint64)


class Coder:
    """Word hashes to codes."""

    def __init__(self, words: np.ndarray, totals: np.ndarray | None = None, types: np.ndarray | None = None, table: str | None = None) -> None:
        order = np.argsort(words)
        self.words, self.codes = words[order], order.astype(np.int64)
        #: Logs of the occurrences of each shared code, unseen words as one, and of its words, an unseen one among them; 0 for codes of one word.
        self.log_totals, self.log_types = np.zeros(CODES), np.zeros(CODES)
        if totals is not None:
            self.log_totals[FREQUENT:], self.log_types[FREQUENT:] = np.log(totals + 1.0), np.log(types + 1.0)
        #: Where the words' counts are written.
        self.table = table

    def __call__(self, h: np.ndarray) -> np.ndarray:
        other = FREQUENT + (h % np.uint64(CODES - FREQUENT)).astype(np.int64)
        if not len(self.words):
            return other
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.codes[at], other)


def coder_of(docs: DataFrame) -> Coder:
    counts = word_counts(docs)
    words = frequent_words(counts)
    # 2^64 is a multiple of the number of shared codes, so signed and unsigned remainders agree
    shared = F.pmod("word", F.lit(CODES - FREQUENT)).cast("int")
    own = counts.sparkSession.createDataFrame([(int(w),) for w in words.view(np.int64)], "word long")
    rows = counts.join(F.broadcast(own), "word", "left_anti").groupBy(shared.alias("code")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c")).collect()
    totals, types = np.zeros((2, CODES - FREQUENT))
    for r in rows:
        totals[r["code"]], types[r["code"]] = r["n"], r["c"]
    return Coder(words, totals, types, counts.written_to)


def dealt(docs: DataFrame, turn: int, rounds: int) -> DataFrame:
    """The documents that are trained on in this round: by a hash of their texts."""
    return docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn)


def contexts(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Codes of the ``2 * SIDE`` neighbours of each position, a column each; beyond a document's ends an own code."""
    out = np.full((2 * SIDE, len(code)), CODES, np.int64)
    for j, d in enumerate([d for d in range(-SIDE, SIDE + 1) if d]):
        at = np.arange(max(0, -d), len(code) - max(0, d))
        ok = at[doc[at] == doc[at + d]]
        out[j, ok] = code[ok + d]
    return out


def fresh(seed: int = 42) -> Params:
    rng = np.random.default_rng(seed)
    draw = lambda scale, *s: (rng.standard_normal(s) * scale).astype(np.float32)
    p = {"e": draw(0.3, EMBED, CODES + 1), "h": draw((2 * SIDE * EMBED) ** -0.5, 2 * SIDE * EMBED, HIDDEN), "hb": np.zeros((HIDDEN, 1), np.float32)}
    for k in range(DIGITS):
        p |= {f"u{k}": draw(HIDDEN**-0.5, HIDDEN, BASE), f"b{k}": np.zeros((BASE, 1), np.float32), f"d{k}": draw(0.3, k, BASE, HIDDEN)}
    return p


def digits(code: np.ndarray) -> list[np.ndarray]:
    return [code >> BITS * (DIGITS - 1 - k) & BASE - 1 for k in range(DIGITS)]


def forward(p: Params, ctx: np.ndarray, own: list[np.ndarray]) -> tuple[np.ndarray, list, list]:
    """Embedded contexts and, for each digit (given those before it), hidden values and scores; a column a position."""
    x = p["e"].take(ctx, axis=1).reshape(EMBED * 2 * SIDE, -1)
    z = p["h"].T @ x
    z += p["hb"]
    hidden, scores = [], []
    for k in range(DIGITS):
        h = z.copy()
        for j in range(k):
            h += p[f"d{k}"][j].take(own[j], axis=0).T
        h /= 1 + np.abs(h)
        hidden.append(h)
        scores.append(p[f"u{k}"].T @ h)
        scores[k] += p[f"b{k}"]
    return x, hidden, scores


def log_probability(p: Params, ctx: np.ndarray, code: np.ndarray) -> np.ndarray:
    out, at, own = np.zeros(len(code)), np.arange(len(code)), digits(code)
    for d, score in zip(own, forward(p, ctx, own)[2], strict=True):
        score -= score.max(axis=0)
        out += score[d, at]
        out -= np.log(np.exp(score, out=score).sum(axis=0))
    return out


def train_step(p: Params, ctx: np.ndarray, code: np.ndarray, rate: float = RATE) -> None:
    """One step of gradient descent on the mean of a batch, in place."""
    n, at, own = len(code), np.arange(len(code)), digits(code)
    x, hidden, scores = forward(p, ctx, own)
    dz = np.zeros_like(hidden[0])
    given = np.zeros((DIGITS - 1, BASE, n), x.dtype)
    for k, d in enumerate(own):
        g, h = scores[k], hidden[k]
        g -= g.max(axis=0)
        np.exp(g, out=g)
        g *= 1 / (n * g.sum(axis=0))
        g[d, at] -= 1 / n
        dh = p[f"u{k}"] @ g
        slope = 1 - np.abs(h)
        slope *= slope
        dh *= slope
        p[f"u{k}"] -= rate * (h @ g.T)
        p[f"b{k}"] -= rate * g.sum(axis=1, keepdims=True)
        if k:
            p[f"d{k}"] -= rate * (given[:k].reshape(k * BASE, n) @ dh.T).reshape(k, BASE, HIDDEN)
        if k < DIGITS - 1:
            given[k, d, at] = 1
        dz += dh
    dx = p["h"] @ dz
    p["h"] -= rate * (x @ dz.T)
    p["hb"] -= rate * dz.sum(axis=1, keepdims=True)
    dx *= -rate * EMBED_RATE
    ctx = ctx.ravel()
    for row, step in zip(p["e"], dx.reshape(EMBED, -1), strict=True):
        np.add.at(row, ctx, step)


def _pack(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unpack(flat: np.ndarray) -> Params:
    out, at, like = {}, 0, fresh()
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def parted(docs: DataFrame, parts: int) -> DataFrame:
    """``part``, ``text``: dealt by a hash of text and id, so that copies spread too, and sorted by it within a part."""
    key = F.xxhash64("text", *[c for c in docs.columns if c == "doc_id"])
    rows = docs.select(F.pmod(key, F.lit(parts)).cast("int").alias("part"), key.alias("_key"), "text")
    return rows.repartitionById(parts, "part").sortWithinPartitions("part", "_key").select("part", "text")


def train_round(docs: DataFrame, coder: Coder, params: Params, parts: int) -> Params:
    """Average of the copies that ``parts`` parts of the documents have trained from ``params``, weighted by positions."""
    shared = docs.sparkSession.sparkContext.broadcast((coder, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, start = shared.value
        total, seen_by_all, part = 0, 0, None

        def finish() -> None:
            nonlocal total, seen_by_all, seen
            if len(left_code):
                train_step(p, left_ctx, left_code, RATE * len(left_code) / BATCH)
                seen += len(left_code)
            if seen:
                total = total + np.round(_pack(p).astype(np.float64) * UNIT).astype(np.int64) * seen // 256
                seen_by_all += seen

        for b in batches:
            of = b.column("part").to_numpy()
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
            for first, end in zip(starts, [*starts[1:], len(of)], strict=True) if len(of) else []:
                if of[first] != part:
                    if part is not None:
                        finish()
                    part, p, seen = of[first], {k: v.copy() for k, v in start.items()}, 0
                    left_ctx, left_code = np.zeros((2 * SIDE, 0), np.int64), np.zeros(0, np.int64)
                for _, texts in ta.passes(b.column("text").slice(first, end - first)):
                    w = ta.split(texts, lower=True)
                    code = coder(ta.word_hashes(w))
                    ctx, code = np.concatenate([left_ctx, contexts(code, w.doc)], axis=1), np.concatenate([left_code, code])
                    whole = len(code) // BATCH * BATCH
                    for i in range(0, whole, BATCH):
                        train_step(p, np.ascontiguousarray(ctx[:, i : i + BATCH]), code[i : i + BATCH])
                    left_ctx, left_code, seen = np.ascontiguousarray(ctx[:, whole:]), code[whole:], seen + whole
        if part is not None:
            finish()
        if seen_by_all:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), seen_by_all, np.int64))], ["at", "v", "n"])

    small_batches(docs.sparkSession)
    sums = parted(docs, parts).mapInArrow(run, "at int, v long, n long").groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    got = sums.toArrow()
    if not got.num_rows:
        return params
    flat = np.zeros(got.num_rows)
    flat[got["at"].to_numpy()] = got["v"].to_numpy() / got["n"].to_numpy() * 256 / UNIT
    return _unpack(flat)


def train(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Coder, Params]:
    spark = docs.sparkSession
    small_batches(spark)
    coder, params = coder_of(docs), fresh()
    positions = spark.read.schema("word long, n long").parquet(coder.table).agg(F.sum("n")).first()[0] or 0
    parts = max(1, min(PARTS, -(-positions // (rounds * PART_WORDS))))
    for turn in range(rounds):
        params = train_round(dealt(docs, turn, rounds), coder, params, parts)
    return coder, params


def score(docs: DataFrame, model: tuple[Coder, Params], keep: list[str], inside: bool = False) -> DataFrame:
    """``keep``, ``n_tokens, log_likelihood`` (summed, of the words), ``mean_log_likelihood`` (of a token), ``seen_elsewhere``
    (the share of the words without codes of their own that the corpus holds) and ``perplexity`` (of a token's code).

    ``inside`` says that ``docs`` are the corpus; what counts then is the corpus without the document itself.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    added = ["n_tokens", "log_likelihood", "mean_log_likelihood", "seen_elsewhere", "perplexity"]
    rows = docs.select(F.struct(*[c for c in keep if c not in added]).alias("_row"), F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, p = shared.value
        for b in batches:
            counts, sums, codes = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows), np.zeros(b.num_rows)
            rare, times, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], np.zeros(b.num_rows + 1, np.int32)
            for at, texts in ta.passes(b.column("_text"), 1 << 18):
                w = ta.split(texts, lower=True)
                h = ta.word_hashes(w)
                code = coder(h)
                ctx = contexts(code, w.doc)
                # filled up: blocks of one shape
                rest = -len(code) % SCORED
                ctx, padded = np.pad(ctx, ((0, 0), (0, rest))), np.pad(code, (0, rest))
                logp = np.concatenate([log_probability(p, np.ascontiguousarray(ctx[:, i : i + SCORED]), padded[i : i + SCORED]) for i in range(0, len(padded), SCORED)] or [np.zeros(0)])[: len(code)]
                counts[at : at + len(texts)] = w.counts
                codes[at : at + len(texts)] = np.bincount(w.doc, weights=logp, minlength=len(texts))
                # as if no other text had the words; what the corpus knows of them is added below
                sums[at : at + len(texts)] = np.bincount(w.doc, weights=logp - (coder.log_totals + coder.log_types)[code], minlength=len(texts))
                # the distinct words of each text that share codes, and how often they stand there
                mine = np.flatnonzero(code >= FREQUENT)
                doc, word = w.doc[mine], h[mine]
                order = np.argsort(word)
                order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
                doc, word = doc[order], word[order]
                new = np.flatnonzero(np.concatenate([np.ones(min(1, len(doc)), bool), (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]))
                rare.append(word[new])
                times.append(np.diff(np.append(new, len(doc))).astype(np.int32))
                sizes[at + 1 : at + 1 + len(texts)] = np.bincount(doc[new], minlength=len(texts))
            with np.errstate(invalid="ignore", divide="ignore"):
                ppl = pa.array(np.exp(-codes / counts), mask=counts == 0)
            ends = pa.array(np.cumsum(sizes, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in ([r.view(np.int64) for r in rare], times)]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(counts), pa.array(sums), ppl, *lists], ["_row", "n_tokens", "_sum", "perplexity", "_rare", "_times"])

    kind = rows.schema["_row"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"_row {kind}, n_tokens long, _sum double, perplexity double, _rare array<long>, _times array<int>")
    # written, so that a row's number is the same wherever it is read
    scored = cut(scored.withColumn("_key", F.monotonically_increasing_id()), "scored")
    counted = spark.read.schema("word long, n long").parquet(model[0].table).where("n > 1" if inside else "n > 0")
    pairs = scored.select("_key", F.explode(F.arrays_zip("_rare", "_times")).alias("_x")).select("_key", F.col("_x._rare").alias("word"), F.col("_x._times").alias("_k"))
    log_types = F.array(*[F.lit(float(x)) for x in model[0].log_types[FREQUENT:]])
    known = pairs.join(counted, "word").withColumn("n", F.col("n") - F.col("_k") if inside else F.col("n")).where("n > 0")
    # each such word: its occurrences in place of an unseen word's part of one
    part = F.round(F.col("_k") * (F.log("n") + F.element_at(log_types, F.pmod("word", F.lit(CODES - FREQUENT)).cast("int") + 1)) * F.lit(UNIT)).cast("long")
    shares = known.groupBy("_key").agg(F.sum(part).alias("_part"), F.sum("_k").alias("_seen"))
    all_rare = F.coalesce(F.aggregate("_times", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    out = scored.select("_key", "_row", "n_tokens", "_sum", "perplexity", all_rare.alias("_all")).join(shares, "_key", "left")
    out = out.withColumn("log_likelihood", F.col("_sum") + F.coalesce(F.col("_part") / F.lit(UNIT), F.lit(0.0)))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    elsewhere = F.when(F.col("_all") > 0, F.coalesce("_seen", F.lit(0)) / F.col("_all"))
    return out.select("_row.*", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"), elsewhere.alias("seen_elsewhere"), "perplexity")
