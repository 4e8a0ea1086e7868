"""Document fingerprints from closed syncmers, in DataFrame operations.

Over a text's words, a run of ``K`` words is an anchor if, among its inner runs of ``S`` words, the
one with the smallest hash stands first or last. Whether a run is an anchor depends on that run
alone, so equal passages have equal anchors wherever they stand. A fingerprint lists all of a text's anchors:
each 32-bit hash with the place of its first word, in order of places. An anchor that repeats is listed each time.

The likeness of two fingerprints matches anchors by position, as multisets: the first place of a hash in one text meets its first
place in the other, the second meets the second, and so on. Such a pair is common if another pair stands at the same relative
position (so a passage must agree in two anchors at least; one is enough if either text has no more). The likeness is the
number of common pairs over that of all anchors of both less the common pairs, so content that stands more often in one text lowers it.

Defined results: a null text is empty; a text without words has an empty fingerprint, alike
only to another empty one. A text of fewer than ``K`` words has one anchor, its whole word
sequence. Documents that repeat an id, or have none, stand next to each other in the order of a hash of their texts; those without
come first. The successor of the last document is the first; a single document succeeds itself. Very long texts
are fingerprinted whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import BROADCAST_IDS, cut, words

K = 8
S = 2
#: Documents of one sorted run, about.
RUN = 512
#: Quantiles of the ids that cut them into buckets, and each bucket again; what is between is cut evenly into runs.
QUANTILES = 128


def with_anchors(rows: DataFrame, text: str, name: str = "anchors") -> DataFrame:
    """Add ``name``: an array of (pos, hash), pos being the first word's number from 0."""
    old = rows.columns
    rows = rows.select(*old, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("_h"))
    inner = F.when(F.size("_h") >= K, F.transform(F.sequence(F.lit(1), F.size("_h") - S + 1), lambda i: F.xxhash64(F.slice("_h", i, S))))
    rows = rows.select(*old, "_h", inner.alias("_s"))
    last = K - S
    # the smallest inner run of each run, once
    least = F.transform(F.sequence(F.lit(1), F.size("_h") - K + 1), lambda i: F.array_min(F.slice("_s", i, last + 1)))
    rows = rows.select(*old, "_h", "_s", F.when(F.size("_h") >= K, least).alias("_m"))
    edge = lambda m, i: F.when((F.get("_s", i) == m) | (F.get("_s", i + last) == m), i + 1)
    picked = F.filter(F.transform("_m", edge), lambda i: i.isNotNull())
    one = lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(F.slice("_h", i, K)).alias("hash"))
    few = F.when(F.size("_h") > 0, F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64("_h").alias("hash"))))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return rows.select(*old, F.when(F.size("_h") >= K, F.transform(picked, one)).otherwise(F.coalesce(few, none)).alias(name))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: an array of (h, o, p), all anchors in order of 32-bit hash and place; ``o`` counts the places of each hash from 0."""
    old = rows.columns
    rows = with_anchors(rows, text, "_anchors")
    low = F.transform("_anchors", lambda x: F.struct(x["hash"].bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"), x["pos"].alias("p")))
    rows = rows.select(*old, F.sort_array(low).alias("_sorted"))
    first = F.transform("_sorted", lambda x, i: F.when(F.coalesce(F.get("_sorted", i - 1)["h"] != x["h"], F.lit(True)), i))
    rows = rows.select(*old, "_sorted", F.filter(first, lambda i: i.isNotNull()).alias("_starts"))
    # the runs of equal hashes, each counted through
    run = lambda i, j: F.slice("_sorted", i + 1, F.coalesce(F.get("_starts", j + 1), F.size("_sorted")) - i)
    counted = lambda i, j: F.transform(run(i, j), lambda x, o: F.struct(x["h"].alias("h"), o.alias("o"), x["p"].alias("p")))
    return rows.select(*old, F.flatten(F.transform("_starts", counted)).alias(name))


def as_text(fingerprint: str) -> Column:
    """Anchors in order of their places: hash (8 hex digits) and place (hex), with a comma between anchors."""
    placed = F.sort_array(F.transform(fingerprint, lambda x: F.struct(x["p"].alias("p"), x["h"].alias("h"))))
    return F.array_join(F.transform(placed, lambda x: F.lower(F.concat(F.lpad(F.hex(x["h"]), 8, "0"), F.hex(x["p"])))), ",")


def with_likeness(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add ``name``: the share of anchors of two fingerprints that are common in hash and relative position.

    Both lists are sorted into one, in which the places of equal hashes and counts are neighbours.
    """
    old = rows.columns
    side = lambda c, k: F.transform(c, lambda x: F.struct(x["h"].alias("h"), x["o"].alias("o"), F.lit(k).alias("k"), x["p"].alias("p")))
    rows = rows.select(*old, F.sort_array(F.concat(side(a, 0), side(b, 1))).alias("_both"))
    before = lambda i: F.get("_both", i - 1)
    pair = lambda x, i: F.when((before(i)["h"] == x["h"]) & (before(i)["o"] == x["o"]), x["p"] - before(i)["p"])
    rows = rows.select(*old, F.sort_array(F.filter(F.transform("_both", pair), lambda d: d.isNotNull())).alias("_shift"))
    agrees = lambda d, i: F.coalesce((F.get("_shift", i - 1) == d) | (F.get("_shift", i + 1) == d), F.get("_shift", i - 1) == d, F.get("_shift", i + 1) == d, F.lit(False))
    common = F.when(F.least(F.size(a), F.size(b)) <= 1, F.size("_shift")).otherwise(F.size(F.filter("_shift", agrees)))
    every = F.size(a) + F.size(b)
    return rows.select(*old, F.when(every == 0, F.lit(1.0)).otherwise(common / (every - common)).alias(name))


def _cuts(rows: DataFrame, key: str, tie: str) -> tuple[list, DataFrame]:
    """Quantiles of the keys, and a table of as many rows and columns with those of each bucket between them."""
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    bounds = sorted(set(rows.agg(F.percentile_approx(key, shares, 10_000)).first()[0] or [0]))
    own = [F.percentile_approx(key, shares, 10_000).alias("_all"), F.count(F.lit(1)).alias("_n"), F.min(tie).alias("_t0"), F.max(tie).alias("_t1"), F.max(key).alias("_high")]
    inner = rows.withColumn("_bucket", _below(F.array(*map(F.lit, bounds)), F.col(key))).groupBy("_bucket").agg(*own)
    return bounds, cut(inner.withColumn("_low", F.array_distinct("_all")), "buckets")


def _below(array: Column, c: Column) -> Column:
    return F.greatest(F.lit(1), F.size(F.filter(array, lambda b: b <= c)))


def _dealt(rows: DataFrame, key: str, tie: str, cuts: tuple[list, DataFrame]) -> DataFrame:
    """Add ``_bucket`` and ``_run``: runs of about ``RUN`` neighbours in the order of ``key`` and ``tie``.

    What stands between two of a bucket's quantiles is cut evenly by key; a key that fills several quantiles is cut by ties.
    """
    columns, (bounds, inner) = rows.columns, cuts
    rows = rows.withColumn("_bucket", _below(F.array(*map(F.lit, bounds)), F.col(key))).join(F.broadcast(inner), "_bucket")
    rows = rows.withColumn("_k", _below(F.col("_low"), F.col(key))).withColumn("_times", F.size(F.filter("_all", lambda b: b == F.col(key))))
    hot = F.col("_times") > 1
    left, right = F.element_at("_low", F.col("_k")).cast("double"), F.coalesce(F.get("_low", F.col("_k")), F.col("_high")).cast("double")
    even = F.when(right > left, (F.col(key).cast("double") - left) / (right - left)).otherwise(F.lit(0.0))
    place = F.when(hot, (F.col(tie).cast("double") - F.col("_t0").cast("double")) / (F.col("_t1").cast("double") - F.col("_t0").cast("double") + 1)).otherwise(even)
    parts = F.ceil(F.when(hot, F.col("_times")).otherwise(F.lit(1)) * F.col("_n") / F.size("_all") / RUN)
    part = F.least(parts - 1, F.greatest(F.lit(0), F.floor(place * parts)))
    run = ((F.col("_k") * 2 + F.when(hot, 0).otherwise(1)) * F.lit(1 << 32) + part).cast("long")
    return rows.select(*columns, "_bucket", run.alias("_run"))


def with_successor(rows: DataFrame, key: str, tie: str, values: list[str], derive: Callable[[DataFrame], DataFrame], derived: list[str]) -> DataFrame:
    """Add ``derived`` and ``next_<value>`` of the row that follows in the order of ``key`` and ``tie``, cyclically.

    ``derive`` makes the columns ``derived`` from ``values``, once for a row. Rows are dealt once, by
    runs of neighbouring keys; the first row of the next run is looked up for each run's last.
    """
    cuts = _cuts(rows, key, tie)
    lean = _dealt(rows.select(key, tie), key, tie, cuts)
    # the least row of each run; beside it that of the next run, or of the next bucket's first run
    firsts = cut(lean.groupBy("_bucket", "_run").agg(F.min(F.struct(key, tie)).alias("_first")), "firsts")
    outer = Window.orderBy("_bucket")
    buckets = firsts.groupBy("_bucket").agg(F.min("_first").alias("_least"))
    round_ = F.first("_least").over(outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    buckets = buckets.select("_bucket", F.coalesce(F.lead("_least").over(outer), round_).alias("_least"))
    inner = F.lead("_first").over(Window.partitionBy("_bucket").orderBy("_run"))
    after = firsts.withColumn("_own", inner).join(F.broadcast(buckets), "_bucket").select("_bucket", "_run", F.coalesce("_own", "_least").alias("_after"))
    after = cut(after.select("_bucket", "_run", F.col(f"_after.{key}").alias("_ak"), F.col(f"_after.{tie}").alias("_at")), "after")
    wanted = after.select(F.col("_ak").alias(key), F.col("_at").alias(tie))
    few = after.count() <= BROADCAST_IDS
    heads = rows.join(F.broadcast(wanted) if few else wanted, [key, tie], "left_semi")
    heads = heads.groupBy(key, tie).agg(F.min(F.struct(*values)).alias("_head"))
    heads = after.join(heads, (F.col("_ak") == F.col(key)) & (F.col("_at") == F.col(tie))).select("_bucket", "_run", *[F.col(f"_head.{v}").alias(v) for v in values])
    heads = derive(cut(heads, "heads")).select("_bucket", "_run", F.struct(*values, *derived).alias("_head"))
    run = Window.partitionBy("_bucket", "_run").orderBy(key, tie)
    # dealt before ``derive``, so that only ``values`` are shuffled
    out = derive(_dealt(rows, key, tie, cuts).repartition("_bucket", "_run"))
    out = out.withColumn("_next", F.lead(F.struct(*values, *derived)).over(run)).join(heads, ["_bucket", "_run"], "left")
    found = F.coalesce("_next", "_head")
    return out.select(*rows.columns, *derived, *[found[v].alias(f"next_{v}") for v in [*values, *derived]])


def compare_edited(docs: DataFrame) -> DataFrame:
    """The fingerprints of all texts and of their edited forms, and the likenesses to those and to the next document's.

    The texts are shuffled once.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id"), F.coalesce("doc_id", F.lit(-(2**63))).alias("_key"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    rows = with_successor(rows, "_key", "_tie", ["_text"], lambda df: with_fingerprint(df, "_text", "_own"), ["_own"])
    size = F.char_length("_text")
    gone = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), size - gone), F.substring("next__text", F.lit(1), gone))
    rows = rows.select("doc_id", "_own", F.col("next__own").alias("_next"), size.cast("long").alias("n_chars"), edited.alias("_edited"))
    rows = with_fingerprint(rows.select("*", F.sha2("_edited", 256).alias("edited_sha256")), "_edited", "_new")
    rows = with_likeness(with_likeness(rows, "_own", "_new", "near_edited"), "_own", "_next", "near_next")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text("_own").alias("fingerprint"), as_text("_new").alias("edited_fingerprint"), "near_edited", "near_next")
