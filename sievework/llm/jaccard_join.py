"""Exact n-gram Jaccard self-join with set relations, and the components of its links.

A document's set holds the hashes of its distinct word shingles. Documents with equal sets are one
node. The index holds, for each node, the shingles of its prefix in an order that puts frequent
shingles last: two sets that link share a prefix shingle. Three set relations keep the work
below all pairs of an index list:

* lists are cut in blocks by set size and position; from its own position a set can tell which
  sizes may still reach the overlap, and visits only those blocks;
* every list has a leader, its most ordinary set; each set of the list is compared with the
  leader alone first, and its overlap is kept as the leader's computed answer;
* for two sets of different components the bounds that follow from their overlaps with the
  common leader decide, where they can; only the rest is compared.

Before texts are compared, parities of the sets' shingles in hash slots bound how much they differ.

Links inside one component are not looked for again, so a group of thousands of near copies costs
one comparison a copy and list leader, not one a pair. No link between different components is
lost: pairs that share an index list and may reach the threshold are all decided.

Defined results: a text without words, or null, has an empty set and is linked with nothing. A null
id keeps its row, with a null component. Repeated rows fall into one class; rows with one id and
different texts are one document with the links of all in ``join``, which answers by id, and documents of their own in ``one_of_each``, which drops rows. Very long texts have sets like others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm import text_arrays as ta
from sievework.llm.common import components, cut, drop, numbered, pick, released, small_batches, without

#: Frequent shingles that the broadcast order holds at most (12 bytes each).
FREQUENT = 1 << 19
#: Shingles that a task gathers before it counts them.
GATHERED = 1 << 21


def frequent_shingles(docs: DataFrame, n: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` shingles found in several documents, sorted, and how often.

    Every document is read; a task passes on what it has seen twice. This only orders the index:
    any order gives the same links.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            token, c = np.unique(np.concatenate(held), return_counts=True)
            token, c = token[c > 1], c[c > 1]
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(c.astype(np.int64))], ["token", "n"])

        for b in batches:
            for _, texts in ta.passes(b.column(0)):
                held.append(ta.shingle_sets(ta.split(texts, lower=True), n)[1])
                size += len(held[-1])
                if size >= GATHERED:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counts = cut(docs.select("text").mapInArrow(released(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n >= 4"), "frequent")
    steps = counts.groupBy(F.floor(F.log2("n") * 4).alias("step")).agg(F.count(F.lit(1)).alias("c")).collect()
    total, least = 0, None
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["c"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counts.where(F.floor(F.log2("n") * 4) >= least).toArrow()
    token, freq = got["token"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(token)
    return token[order], freq[order]


def prefixes(docs: DataFrame, n: int, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``doc_id, n, sig, rare, prefix, sketch``: set size, digest of the set, its infrequent shingles, its prefix in
    index order, and the parities of its shingles in as many hash slots as it has shingles (a power of two, 256 at least).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, freq = shared.value
        for b in batches:
            sizes, sigs, rares, parts, lens, sketches, widths = [], [], [], [], [], [], []
            for _, texts in ta.passes(b.column("text")):
                doc, token = ta.shingle_sets(ta.split(texts, lower=True), n)
                first = np.searchsorted(doc, np.arange(len(texts) + 1))
                at = np.minimum(np.searchsorted(known, token), max(len(known) - 1, 0))
                f = np.where(known[at] == token, freq[at], 0) if len(known) else np.zeros(len(token), np.int64)
                order = np.lexsort((token, f, doc))
                size = np.diff(first)
                keep = np.where(size > 0, size - (num * size + den - 1) // den + 1, 0)
                place = np.arange(len(token)) - np.repeat(first[:-1], size)
                parts.append(token[order][place < np.repeat(keep, size)])
                lens.append(keep)
                sizes.append(size)
                rares.append(np.bincount(doc[f == 0], minlength=len(texts)))
                raw = token.tobytes()
                width = np.maximum(256, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
                bit = np.concatenate([[0], np.cumsum(width)])
                odd = np.bincount(bit[doc] + (token & (width[doc] - 1).astype(np.uint64)).astype(np.int64), minlength=bit[-1]).astype(np.uint8) & 1
                sketches.append(np.packbits(odd, bitorder="little").view("<i8"))
                widths.append(width // 64)
                sigs += [hashlib.blake2b(raw[8 * i : 8 * j], digest_size=16).digest() for i, j in zip(first[:-1], first[1:], strict=True)]

            def lists(values: list[np.ndarray], counts: list[np.ndarray]) -> pa.ListArray:
                offsets = np.zeros(b.num_rows + 1, np.int32)
                np.cumsum(np.concatenate(counts) if counts else [], out=offsets[1:])
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array((np.concatenate(values) if values else np.zeros(0, np.int64)).view(np.int64)))

            cat = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), cat(sizes), pa.array(sigs, pa.binary()), cat(rares), lists(parts, lens), lists(sketches, widths)], ["doc_id", "n", "sig", "rare", "prefix", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(make), "doc_id long, n long, sig binary, rare long, prefix array<long>, sketch array<long>")


def overlaps(pairs: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """``a, b`` with ``na, nb`` and ``o``, the size of their sets' intersection, from the whole texts."""
    small_batches(docs.sparkSession, 128)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text")).where("_id is not null")
    ends = pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id")))
    texts = pick(texts, ends, "_id")
    left = pairs.join(texts, F.col("a") == F.col("_id")).select("a", "b", F.col("_text").alias("ta"))
    both = left.join(texts, F.col("b") == F.col("_id")).select("a", "b", "ta", F.col("_text").alias("tb"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            weight = np.cumsum(np.asarray(pc.add(pc.binary_length(b.column("ta")), pc.binary_length(b.column("tb")))))
            while at < b.num_rows:
                done = weight[at - 1] if at else 0
                rows = max(1, int(np.searchsorted(weight, done + ta.PASS_BYTES, side="right")) - at)
                part = b.slice(at, rows)
                at += rows
                da, xa = ta.shingle_sets(ta.split(part.column("ta"), lower=True), n)
                db, xb = ta.shingle_sets(ta.split(part.column("tb"), lower=True), n)
                doc, token = np.concatenate([da, db]), np.concatenate([xa, xb])
                order = np.lexsort((token, doc))
                doc, token = doc[order], token[order]
                same = (doc[1:] == doc[:-1]) & (token[1:] == token[:-1])
                k = part.num_rows
                counts = [np.bincount(x, minlength=k).astype(np.int64) for x in (da, db, doc[1:][same])]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), *map(pa.array, counts)], ["a", "b", "na", "nb", "o"])

    return both.mapInArrow(released(count), "a long, b long, na long, nb long, o long")


def _links(o: Column, na: Column, nb: Column, num: int, den: int) -> Column:
    return den * o >= num * (na + nb - o)


def unlike(a: str, b: str) -> Column:
    """Slots in which two sketches differ: no more than shingles that only one of the sets has. The longer is folded once."""
    half = lambda x: F.size(x) / 2
    folded = lambda x: F.zip_with(F.slice(x, F.lit(1), half(x).cast("int")), F.slice(x, (half(x) + 1).cast("int"), half(x).cast("int")), lambda p, q: p.bitwiseXOR(q))
    pa_, pb = F.when(F.size(a) > F.size(b), folded(a)).otherwise(F.col(a)), F.when(F.size(b) > F.size(a), folded(b)).otherwise(F.col(b))
    bits = F.zip_with(pa_, pb, lambda p, q: F.coalesce(F.bit_count(p.bitwiseXOR(q)), F.lit(0)))
    return F.aggregate(bits, F.lit(0), lambda s, x: s + x)


def alike(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sketches leave room for the overlap; no link is lost."""
    s = nodes.select(F.col("node").alias("_n"), F.col("n").alias("_size"), "sketch")
    left = pairs.select("a", "b").join(s, F.col("a") == F.col("_n")).select("a", "b", F.col("_size").alias("na"), F.col("sketch").alias("sa"))
    both = left.join(s, F.col("b") == F.col("_n")).select("a", "b", "na", F.col("_size").alias("nb"), "sa", F.col("sketch").alias("sb"))
    both = both.where((num + den) * (F.col("na") + F.col("nb") - unlike("sa", "sb")) >= 2 * num * (F.col("na") + F.col("nb")))
    return both.select("a", "b").distinct()


def join(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``: the smallest id that links reach.

    The threshold must be 1/2 or more: below, sketches of two sets that link can need to be folded more than once.
    """
    spark, (num, den) = docs.sparkSession, threshold
    if not den <= 2 * num <= 2 * den:
        raise ValueError("the threshold must be from 1/2 to 1")
    small_batches(spark)
    base = cut(prefixes(docs, n, num, den, frequent_shingles(docs, n)), "prefixes")
    nodes = cut(base.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("rare").alias("rare"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch")), "nodes")
    index = nodes.select("node", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    leaders = index.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rare", "node", "n", "pos")).alias("l")).where("c > 1")
    # written, so that the join below has two plain shuffles, of which a frequent shingle's part can be split
    leaders = cut(leaders.select("token", F.col("l.node").alias("leader"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lpos")), "leaders")
    lists = first = cut(index.drop("rare").join(leaders, "token"), "lists")

    def possible(na: str, pa_: str, nb: str, pb: str) -> Column:
        """Sizes and positions of a common shingle that leave room for the overlap."""
        reach = F.least(F.col(na) - F.col(pa_), F.col(nb) - F.col(pb))
        return (den * F.least(na, nb) >= num * F.greatest(na, nb)) & ((num + den) * reach >= num * (F.col(na) + F.col(nb)))

    # 1. every set against the leaders of its lists
    own = lists.where("node <> leader").where(possible("n", "pos", "ln", "lpos"))
    asked = cut(alike(own.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), nodes, num, den), "asked")
    known = cut(overlaps(asked, docs, n), "known")
    links = known.where(_links(F.col("o"), F.col("na"), F.col("nb"), num, den)).select("a", "b")
    near = cut(components(links), "near")

    # 2. what is left between different components
    label = near.select(F.col("node").alias("_node"), F.col("component").alias("_c"))
    lists = labelled = cut(lists.join(label, F.col("node") == F.col("_node"), "left").withColumn("comp", F.coalesce("_c", "node")).drop("_node", "_c"), "labelled")
    mixed = cut(lists.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token"), "mixed")
    lists = lists.join(mixed, "token", "left_semi")
    answers = known.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "o")
    lists = lists.join(answers, (F.col("node") == F.col("_a")) & (F.col("leader") == F.col("_b")), "left").drop("_a", "_b")
    # the leader's overlap with itself is its size; a set that was not compared with it has none known
    lists = lists.withColumn("o", F.when(F.col("node") == F.col("leader"), F.col("n")).otherwise(F.col("o")))
    block = lambda size: F.floor(F.log(size.cast("double")) / F.log(F.lit(den / num)) + 1e-9).cast("int")
    # sizes that a partner may have: none above what this position still allows, none below the threshold's share
    most = F.least(F.floor(F.col("n") * den / num), F.floor((F.col("n") - F.col("pos")) * (num + den) / num) - F.col("n"))
    least = F.ceil(F.col("n") * num / den)
    probe = lists.where(most >= least).withColumn("block", F.explode(F.sequence(block(least), block(most))))
    probe = probe.select("token", "block", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "pos", "comp", "o")], "ln", "leader")
    visit = lists.withColumn("block", block(F.col("n"))).select("token", "block", *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "pos", "comp", "o")])
    met = probe.join(visit, ["token", "block"]).where("x_node < y_node and x_comp <> y_comp").where(possible("x_n", "x_pos", "y_n", "y_pos"))
    # overlaps with the common leader bound the overlap of the two
    upper = F.least("x_o", "y_o") + F.least(F.col("x_n") - F.col("x_o"), F.col("y_n") - F.col("y_o"))
    lower = F.greatest(F.lit(0), F.col("x_o") + F.col("y_o") - F.col("ln"))
    met = met.groupBy(F.col("x_node").alias("a"), F.col("y_node").alias("b")).agg(F.first("x_n").alias("na"), F.first("y_n").alias("nb"), F.min(upper).alias("upper"), F.max(lower).alias("lower"))
    met = cut(met, "met")
    sure = met.where(_links(F.col("lower"), F.col("na"), F.col("nb"), num, den)).select("a", "b")
    open_ = met.where(~F.coalesce(_links(F.col("lower"), F.col("na"), F.col("nb"), num, den), F.lit(False)) & F.coalesce(_links(F.col("upper"), F.col("na"), F.col("nb"), num, den), F.lit(True)))
    tried = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    untried = cut(alike(open_.select("a", "b").join(tried, ["a", "b"], "left_anti"), nodes, num, den), "open")
    compared = overlaps(untried, docs, n)
    more = compared.where(_links(F.col("o"), F.col("na"), F.col("nb"), num, den)).select("a", "b")
    more = cut(sure.union(more), "more")

    groups = components(near.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    drop(leaders, first, labelled, asked, known, near, mixed, met, untried, more)
    classes = nodes.select("sig", "node").join(groups, "node", "left").select("sig", F.coalesce("component", "node").alias("component_id"))
    out = base.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("sig")).alias("sig"))
    out = out.join(classes, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out.reads = [base, nodes]
    return out


def one_of_each(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the document with the smallest id stays.

    Of equal rows one stays; rows with a null id stay. Rows with one id and different texts are documents of their own.
    """
    linked = join(docs, n, threshold)
    found = cut(linked, "components")
    own = linked.reads[0].where("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("sig")).alias("lo"), F.max(F.xxhash64("sig")).alias("hi"))
    several = not own.where("lo <> hi").isEmpty()
    drop(*linked.reads)
    if several:
        return _one_of_each_row(docs, n, threshold)
    rest = without(docs, found.where("doc_id <> component_id"), "doc_id")
    repeated = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1 and doc_id is not null")
    if repeated.isEmpty():
        return rest
    # only rows whose ids repeat are held against each other
    ids = cut(repeated.select("doc_id"), "repeated")
    return without(rest, ids, "doc_id").unionByName(rest.join(ids, "doc_id", "left_semi").select(*rest.columns).dropDuplicates())


def _one_of_each_row(docs: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    """``one_of_each`` where ids don't tell texts apart: rows are numbered by id and text, and the numbers are linked."""
    rows = numbered(docs.dropDuplicates().withColumn("_text_key", F.md5(F.col("text").cast("binary"))), ["doc_id", "_text_key"], "_row")
    rows = cut(rows, "numbered")
    linked = join(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("_row")).alias("doc_id"), "text"), n, threshold)
    gone = cut(linked.where("doc_id <> component_id").select(F.col("doc_id").alias("_row")), "near-duplicates")
    drop(*linked.reads)
    return without(rows, gone, "_row").select(*docs.columns)
