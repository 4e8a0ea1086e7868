"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations.

A benchmark item's windows are its runs of ``WINDOW`` words, or the whole item if it is shorter. The index
stores a posting (word, text, place) for every place of a benchmark word in a training text; it is written as texts are
read, so they are cut into words once, and word counts over the corpus come from it. Each window is looked up by its
``LISTS`` rarest words: its rarest list, less the word's place in the window, gives places where the window can
begin; these are intersected with the offset-adjusted lists of the next rarest words by equality (phrases), or by
distance (proximity). What is left is compared word by word with the texts, of which only those with a surviving
place are cut into words again.

Texts are known by their MD5. Lists that are intersected have each place of a text once, however many copies it has,
and are dealt by word, text and place, so no frequent word, long text or group of copies is one task's. Windows and
words are broadcast only up to a counted size and joined by shuffles beyond it.

Defined results: a null or empty text or item has no words; an item without words has no window. Rows that
repeat are each given their result. A benchmark row with a null id still hits words, but has no id to be
listed; rows that repeat an item are one. An empty benchmark contaminates nothing. Very long texts need memory for the
words of one text. Other columns pass if they are asked for; those named like results give way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import cut, drop

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Lists that are intersected before texts are read.
LISTS = 3
#: Words within which all distinct words of a window must stand to be near each other.
SPAN = 20
#: The posting word that stands at a text's number of words.
END = -1
#: Rows that a broadcast of windows, words or text keys holds at most.
BROADCAST_ROWS = 1 << 18
RESULTS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def text_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other letters stay as they are."""
    ascii_ = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.array_remove(F.split(F.coalesce(lower, F.lit("")), GAP), "")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def small(rows: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


@dataclass
class Index:
    """``windows``: id ``w``, words ``win`` and its rarest words with offsets; ``owners``: ``w, item``; ``postings``: ``t, h, pos``
    of all benchmark words, a row for each copy of a text, and those at ``END``; ``lists``: those of the windows' rarest words, each once."""

    windows: DataFrame
    owners: DataFrame
    postings: DataFrame
    lists: DataFrame

    def drop(self) -> None:
        drop(self.windows, self.owners, self.postings, self.lists)

    def text_sizes(self) -> DataFrame:
        """``h, n_words`` of each text."""
        return self.postings.where(F.col("t") == END).groupBy("h").agg(F.max("pos").cast("long").alias("n_words"))


def item_windows(benchmark: DataFrame, item: str, text: str, length: int) -> tuple[DataFrame, DataFrame]:
    """(distinct windows with an id, the items of each)."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), text_words(F.col(text)).alias("_words")).where("size(_words) > 0")
    starts = F.when(F.size("_words") > length, F.sequence(F.lit(1), F.size("_words") - length + 1)).otherwise(F.array(F.lit(1)))
    runs = cut(items.select("item", "_words", F.explode(starts).alias("_s")).select("item", F.slice("_words", F.col("_s"), length).alias("win")), "item-windows")
    # written, so that ids stay what they are
    windows = cut(runs.select("win").distinct().withColumn("w", F.monotonically_increasing_id()), "windows")
    owners = cut(runs.join(small(windows), "win").select("w", "item").distinct(), "owners")
    drop(runs)
    return windows, owners


def build(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", length: int = WINDOW, lists: int = LISTS) -> Index:
    """Store the postings of the benchmark's words, count these, and choose each window's ``lists`` rarest."""
    windows, owners = item_windows(benchmark, item, "text", length)
    places = windows.select("w", F.posexplode("win").alias("o", "word"))
    words = cut(places.select("word").distinct().withColumn("t", F.monotonically_increasing_id()), "words")
    # the empty word after the last one stands at the number of words
    known = cut(words.union(docs.sparkSession.range(1).select(F.lit(""), F.lit(END).cast("long"))), "known-words")
    run = F.array_append(text_words(F.col(text)), F.lit(""))
    # keys and words are made before the rows are exploded, not for each word; an outer explode asks for no filter, which would cut texts into words again
    tokens = docs.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("h"), run.alias("_words")).select("h", F.posexplode_outer("_words").alias("pos", "word"))
    postings = cut(tokens.join(small(known), "word").select("t", "h", "pos"), "postings")
    counts = cut(postings.where(F.col("t") != END).groupBy("t").agg(F.count(F.lit(1)).alias("n")).join(words, "t"), "counts")
    # a window with a word that the corpus lacks can't occur
    ranked = places.join(small(counts), "word").groupBy("w").agg(F.sort_array(F.collect_list(F.struct("n", "o", "t"))).alias("_r"))
    ranked = ranked.join(windows, "w").where(F.size("_r") == F.size("win"))
    at = lambda k: F.get("_r", F.lit(k))
    columns = [c for k in range(lists) for c in (at(k)["t"].alias(f"t{k}"), at(k)["o"].alias(f"o{k}"))]
    found = cut(ranked.select("w", "win", *columns), "ranked")
    used = cut(found.select(F.explode(F.array(*[f"t{k}" for k in range(lists)])).alias("t")).where("t is not null").distinct(), "list-words")
    rarest = cut(postings.join(small(used), "t", "left_semi").distinct(), "lists")
    drop(windows, words, known, counts, used)
    return Index(found, owners, postings, rarest)


def _rarest(index: Index, lists: int) -> DataFrame:
    """Places of each window's rarest word: ``w, h, pos`` with the window's offsets and next words."""
    rest = [c for k in range(1, lists) for c in (f"t{k}", f"o{k}")]
    ask = index.windows.select("w", F.col("t0").alias("t"), "o0", *rest)
    return index.lists.join(small(ask), "t").drop("t")


def phrase_places(index: Index, lists: int = LISTS) -> DataFrame:
    """``w, h, start``: where the offset-adjusted lists of a window's rarest words agree."""
    here = _rarest(index, lists).withColumn("start", F.col("pos") - F.col("o0")).where("start >= 0").drop("pos", "o0")
    for k in range(1, lists):
        lists_k = index.lists.select(F.col("t").alias("_t"), F.col("h").alias("_h"), F.col("pos").alias("_pos"))
        agree = (F.col(f"t{k}") == F.col("_t")) & (F.col("h") == F.col("_h")) & (F.col("start") + F.col(f"o{k}") == F.col("_pos"))
        short = here.where(F.col(f"t{k}").isNull())
        here = here.where(F.col(f"t{k}").isNotNull()).join(lists_k, agree, "left_semi").union(short)
    return here.select("w", "h", "start")


def near_places(index: Index, span: int = SPAN, lists: int = LISTS) -> DataFrame:
    """``w, h, pos``: places of a window's rarest word with its next rarest words less than ``span`` words away, on either side."""
    here = _rarest(index, lists).drop("o0")
    for k in range(1, lists):
        bucket = lambda c: F.floor(c / span)
        lists_k = index.lists.select(F.col("t").alias("_t"), F.col("h").alias("_h"), F.col("pos").alias("_pos"), bucket(F.col("pos")).alias("_b"))
        asked = here.where(F.col(f"t{k}").isNotNull()).withColumn("_near", F.explode(F.array(*[bucket(F.col("pos")) + i for i in (-1, 0, 1)])))
        agree = (F.col(f"t{k}") == F.col("_t")) & (F.col("h") == F.col("_h")) & (F.col("_near") == F.col("_b")) & (F.abs(F.col("pos") - F.col("_pos")) < span)
        met = asked.join(lists_k, agree, "left_semi").drop("_near").distinct()
        here = met.union(here.where(F.col(f"t{k}").isNull()))
    return here.select("w", "h", "pos")


def _with_texts(docs: DataFrame, places: DataFrame, windows: DataFrame, text: str, place: str) -> DataFrame:
    """``h, _words, _asked``: each text that has places, once, with its places and the words to be found there."""
    asked = places.join(small(windows.select("w", "win")), "w").groupBy("h").agg(F.collect_list(F.struct(place, "w", "win")).alias("_asked"))
    asked = cut(asked, "asked")
    rows = docs.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("h"), F.col(text).alias("_text"))
    once = rows.join(small(asked.select("h")), "h", "left_semi").dropDuplicates(["h"])
    return once.join(asked, "h").select("h", text_words(F.col("_text")).alias("_words"), "_asked")


def phrases(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """``h, hits``: texts with the windows that stand in them word by word: an array of (start, w, length), in order."""
    rows = _with_texts(docs, cut(phrase_places(index), "places"), index.windows, text, "start")
    # named twice, words are a projection of their own; named once, they would be made anew for each place
    inside = lambda x: x["start"] + F.size(x["win"]) <= F.size("_words")
    same = F.filter("_asked", lambda x: inside(x) & (F.slice("_words", x["start"] + 1, F.size(x["win"])) == x["win"]))
    hits = F.sort_array(F.transform(same, lambda x: F.struct(x["start"], x["w"], F.size(x["win"]).alias("length"))))
    # written first: a filter on it would be moved below the projection of words
    return cut(rows.select("h", hits.alias("hits")), "hits").where("size(hits) > 0")


def proximity(docs: DataFrame, index: Index, span: int = SPAN, text: str = "text") -> DataFrame:
    """``h, near``: texts with the windows all of whose words stand, in any order, within ``span`` words: an array of ids."""
    rows = _with_texts(docs, cut(near_places(index, span), "near"), index.windows, text, "pos")
    runs = lambda x: F.sequence(F.greatest(x["pos"] - span + 1, F.lit(0)), x["pos"])
    lacks = lambda x, s, n: F.size(F.array_except(x["win"], F.slice("_words", s + 1, n)))
    around = lambda x: F.greatest(x["pos"] - span + 1, F.lit(0))
    all_in = lambda x: (lacks(x, around(x), x["pos"] + span - around(x)) == 0) & F.exists(runs(x), lambda s: lacks(x, s, F.lit(span)) == 0)
    near = F.array_distinct(F.transform(F.filter("_asked", all_in), lambda x: x["w"]))
    return cut(rows.select("h", near.alias("near")), "near-hits").where("size(near) > 0")


def covered(hits: str) -> Column:
    """Words that lie in any of the hits, which are in order."""
    step = lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(a["end"], x["start"]))).alias("n"), F.greatest(a["end"], x["start"] + x["length"]).alias("end"))
    return F.aggregate(hits, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda a: a["n"].cast("long"))


def verdicts(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", length: int = WINDOW) -> DataFrame:
    """``keep``, ``n_words, n_hit`` (words inside occurring windows), ``n_items`` (items with such windows), ``items_sha256``, ``contaminated``."""
    index = build(docs, benchmark, text, item, length)
    found = cut(phrases(docs, index, text).select("h", covered("hits").alias("n_hit"), F.array_distinct(F.transform("hits", lambda x: x["w"])).alias("ws")), "phrases")
    listed = found.select("h", F.explode("ws").alias("w")).join(small(index.owners.where("item is not null")), "w").groupBy("h").agg(F.sort_array(F.collect_set("item")).alias("items"))
    listed = found.join(listed, "h", "left").select("h", "n_hit", F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("long").alias("n_items"), F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"))
    listed = cut(listed, "listed")
    sizes = cut(index.text_sizes().join(listed, "h", "left"), "sizes")
    index.drop()
    keep = [c for c in keep if c not in RESULTS]
    rows = docs.select(F.struct(*keep).alias("_row") if keep else F.lit(0).alias("_row"), text_key(F.col(text)).alias("h"))
    out = rows.join(small(sizes), "h", "left")
    return out.select(
        *(["_row.*"] if keep else []),
        F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
