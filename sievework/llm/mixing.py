"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations.

Each source has a schedule: its weight as a linear function of training time in [0, 1], from
``start`` to ``end``. The integral of the schedule is the source's cumulative demand for tokens.
A document copy that begins after a share q of its source's taken words is placed at the time
when the integrated demand reaches q, and the mixture is sorted by that time.

How much a source gives follows from its mean weight: targets share ``budget`` times all words
by weight and stop at ``cap`` times the source's own words; what is above goes to the other
sources by weight. Within a source documents are taken in the order of a hash of their id, pass
after pass, to the very word of the target: the last document of the last pass is taken in part.

Defined results: a null source is a source like others, the last. A null text has size 0 and is
taken 0 times. Repeated rows and rows that share an id or have none take part each for itself; null ids are ordered by
a hash of their text. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import cut, words

WEIGHTS = (5, 2, 1)
#: (start, end) of the schedules of sources with these weights: heavy ones early, light ones late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
BUDGET = 1.5
CAP = 2.0
#: Documents that one running sum holds, about.
RUN = 4096


def targets(sources: DataFrame, budget: float = BUDGET, cap: float = CAP, weights: tuple = WEIGHTS) -> DataFrame:
    """``source, source_size`` with ``weight``, its schedule and ``target``.

    Sorted by size over weight, the sources that reach the cap come first; the level at which the
    others share the rest is found from running sums. The table has one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), by.cast("int") + 1)
    s = sources.withColumns({"weight": pick(weights), "start": pick([a for a, _ in SCHEDULES]), "end": pick([b for _, b in SCHEDULES])})
    s = s.withColumn("_most", F.col("source_size") * F.lit(cap)).withColumn("_ratio", F.col("_most") / F.col("weight"))
    up = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns({"_full": F.coalesce(F.sum("_most").over(up), F.lit(0.0)), "_gone": F.coalesce(F.sum("weight").over(up), F.lit(0.0)), "_all": F.sum("source_size").over(every), "_weights": F.sum("weight").over(every)})
    # this source's share if all before it are full and it isn't
    s = s.withColumn("_level", (F.col("_all") * F.lit(budget) - F.col("_full")) / (F.col("_weights") - F.col("_gone")))
    s = s.withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(every))
    target = F.least(F.col("_most"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_most")))
    return s.select("source", "source_size", "weight", "start", "end", target.alias("target"))


def time_of(share: Column, start: Column, end: Column) -> Column:
    """When the integral of the line from ``start`` to ``end`` has reached ``share`` of its whole."""
    slope = end - start
    area = share * (start + end) / 2
    return F.when(F.abs(slope) < 1e-12, share).otherwise((F.sqrt(start * start + F.lit(2.0) * slope * area) - start) / slope + F.lit(0.0))


def mix(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A row per document: ``keep`` (default: all columns), ``size, source_size, target, taken`` and the
    training times ``position`` and ``position_again`` at which its first and second copies stand (null if not taken).
    Input columns of these names give way.

    Only ids, sources and sizes are shuffled, unless ``keep`` asks for more.
    """
    added = ["size", "source_size", "target", "taken", "position", "position_again"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    size = F.size(words(F.col("text"))).cast("long")
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select(F.struct(*keep).alias("_row"), F.col("source").alias("_source"), size.alias("size"), F.md5(F.concat(F.lit("42:"), name)).alias("_order"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_tie"))
    rows = cut(rows, "sizes")
    sources = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    goal = cut(targets(sources).join(sources.select(F.col("source").alias("_s"), "n_docs"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "targets")
    goal = goal.withColumn("_runs", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(RUN)).cast("int")))
    rows = rows.join(goal.select(F.col("source").alias("_key"), "source_size", "start", "end", "target", "_runs"), F.col("_source").eqNullSafe(F.col("_key"))).drop("_key")
    # the hash order of a source, dealt into runs: a running sum inside each, the sums of whole runs before it
    share = F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = rows.withColumn("_run", F.floor(share * F.col("_runs")).cast("long"))
    sums = rows.groupBy(F.col("_source").alias("_key"), F.col("_run").alias("_at")).agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    inside = Window.partitionBy("_source", "_run").orderBy("_order", "_id", "size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums.drop("_sum"), F.col("_source").eqNullSafe(F.col("_key")) & (F.col("_run") == F.col("_at"))).withColumn("_from", F.col("_before") + F.col("_inside"))
    whole = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    part = whole - full * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), part - F.col("_from")))
    rows = rows.withColumns({"taken": (full * F.col("size") + last).cast("long"), "_whole": whole})
    at = lambda words_before: time_of(words_before / F.col("_whole"), F.col("start"), F.col("end"))
    first = F.when(F.col("taken") > 0, at(F.col("_from")))
    again = F.when(F.col("taken") > F.col("size"), at(F.col("_from") + F.col("source_size")))
    return rows.select("_row.*", "size", "source_size", "target", "taken", first.alias("position"), again.alias("position_again"))


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, sorted by training position: dropped, once or twice.

    A last copy that is taken in part holds the first words of the text, joined by one space.
    """
    n = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    # ids that tell all rows apart are enough for the join; else whole rows go through the mix
    own = ["_id"] if n["rows"] == n["ids"] else ["_id", "_all"]
    plain = docs.select("doc_id", "text", "source", F.col("doc_id").alias("_id"), F.struct(*docs.columns).alias("_all"))
    mixed = mix(plain, keep=own).where("taken > 0")
    copies = F.array(
        F.struct(F.col("position").alias("at"), F.least("taken", "size").alias("n")),
        F.struct(F.col("position_again").alias("at"), (F.col("taken") - F.col("size")).alias("n")),
    )
    taken = mixed.select(*own, F.col("size").alias("_size"), F.explode(copies).alias("_copy")).where("_copy.n > 0")
    rows = docs.join(taken, F.col("doc_id") == F.col("_id")) if len(own) == 1 else taken.select("_all.*", "_size", "_copy")
    part = F.array_join(F.slice(words(F.col("text")), F.lit(1), F.col("_copy.n").cast("int")), " ")
    text = F.when(F.col("_copy.n") < F.col("_size"), part).otherwise(F.col("text"))
    rows = rows.orderBy("_copy.at", "doc_id").withColumn("text", text)
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else rows
    return rows.select(*docs.columns)
