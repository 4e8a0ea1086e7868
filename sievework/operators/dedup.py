"""Exact and near duplicates by 64-bit hashes, their clusters, and who is kept. In near duplicates and clusters a null label is a label like others."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.hashing import hamming
from sievework.operators.graph import components
from sievework.operators.joins import counted, same_keys, shuffled
from sievework.sources.shared import cut, numbered

TIGHT, LOOSE = 4, 8
MAX_AUGMENTED = 6
SHARPNESS_FLOOR = 0.3
#: Slices in which a cluster's rows are ranked before the slices' first rows are.
SLICES = 64


def collisions(df: DataFrame, hash_: str, label: str) -> DataFrame:
    """All members of the hashes that stand under several labels."""
    several = df.groupBy(hash_).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi")).where("_lo <> _hi").select(hash_)
    return df.join(several, hash_, "left_semi")


#: Ways to cut a hash, as (slices, bits that may differ in a slice).
CUTS = ((9, 0), (5, 0), (5, 1), (3, 1), (3, 2), (2, 2))


def cut_for(most: int, rows: int) -> tuple[int, int]:
    """The cheapest of ``CUTS`` that loses no pair at most ``most`` bits apart.

    ``n`` slices with ``r`` differing bits hold all pairs up to n (r + 1) - 1 bits apart (pigeonhole). Wide slices with
    near values looked up cost more rows but hold ever fewer pairs that aren't near, so they win as rows grow.
    """

    def cost(n: int, r: int) -> float:
        width = 64 // n
        values = n * sum(math.comb(width, k) for k in range(r + 1))
        return rows * values + rows * rows * values / 2**width / 2

    return min(((n, r) for n, r in CUTS if n * (r + 1) > most), key=lambda c: cost(*c), default=(most + 1, 0))


def bands(hash_: Column, n: int, near: int = 0) -> Column:
    """``n`` slices of 64 bits as (band, value), with all values at most ``near`` bits from the slice's own."""
    edges = [i * 64 // n for i in range(n + 1)]
    part = lambda i: F.shiftrightunsigned(F.shiftleft(hash_, 64 - edges[i + 1]), 64 - edges[i + 1] + edges[i])
    if not near:
        return F.array(*[F.struct(F.lit(i).alias("band"), part(i).alias("value")) for i in range(n)])
    flips = lambda width: [sum(1 << k for k in c) for r in range(near + 1) for c in combinations(range(width), r)]
    masks = lambda i: F.expr("array(" + ", ".join(f"{m}L" for m in flips(edges[i + 1] - edges[i])) + ")")
    around = lambda i: F.transform(masks(i), lambda m: F.struct(F.lit(i).alias("band"), part(i).bitwiseXOR(m).alias("value")))
    return F.concat(*[around(i) for i in range(n)])


def hash_classes(df: DataFrame, hashes: list[str], label: str, order: str) -> DataFrame:
    """One row for each label and hash: copies with equal hashes are one class, its first row the representative."""
    return df.groupBy(label, *hashes).agg(F.min(order).alias("rep"), F.count(F.lit(1)).alias("members"))


def near_pairs(classes: DataFrame, label: str, most: int, hash_: str = "hash", flipped: str | None = None, banded: bool = True, cut_by: tuple[int, int] | None = None) -> DataFrame:
    """``label, rep_a, rep_b, distance`` of classes of one label at most ``most`` bits apart, the earlier first.

    With ``flipped`` the distance is the smaller of the plain one and that of a's mirrored hash to
    b's plain one. Classes meet on bands, cut as their number asks for (or by ``cut_by``), so a label's pairs are not all
    compared; with ``banded`` off they are, for thresholds where bands would hold almost nothing apart.
    """
    cols = [c for c in (hash_, flipped) if c]
    a = classes.select(label, F.col("rep").alias("rep_a"), *[F.col(c).alias(f"a_{c}") for c in cols])
    b = classes.select(F.col(label).alias("_l"), F.col("rep").alias("rep_b"), F.col(hash_).alias("b_hash"))
    on = F.col(label).eqNullSafe(F.col("_l")) & (F.col("rep_a") < F.col("rep_b"))
    if banded:
        n, near = cut_by or cut_for(most, classes.count())
        # a mirrored hash looks for its partners too
        probes = F.array_union(*[bands(F.col(f"a_{c}"), n, near) for c in cols]) if flipped else bands(F.col(f"a_{hash_}"), n, near)
        a = a.select("*", F.explode(probes).alias("_x"))
        b = b.select("*", F.explode(bands(F.col("b_hash"), n)).alias("_y"))
        on &= F.col("_x") == F.col("_y")
    d = F.least(*[hamming(F.col(f"a_{c}"), F.col("b_hash")) for c in cols]) if flipped else hamming(F.col(f"a_{hash_}"), F.col("b_hash"))
    met = a.join(shuffled(b) if banded else b, on).select(label, "rep_a", "rep_b", d.alias("distance")).where(F.col("distance") <= most)
    return met.distinct() if banded else met


def degrees(classes: DataFrame, pairs: DataFrame, members: str = "members") -> DataFrame:
    """``rep, links``: how many rows of other classes each class' rows are linked with, for every class."""
    size = classes.select(F.col("rep").alias("_r"), F.col(members).alias("_m"))
    ends = pairs.select(F.col("rep_a").alias("rep"), F.col("rep_b").alias("_other")).union(pairs.select("rep_b", "rep_a"))
    linked = ends.join(size, F.col("_other") == F.col("_r")).groupBy("rep").agg(F.sum("_m").alias("links"))
    return classes.select("rep").join(linked, "rep", "left").select("rep", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def links(classes: DataFrame, label: str, most: int, hash_: str = "hash", cut_by: tuple[int, int] | None = None) -> DataFrame:
    """``rep_a, rep_b``: near pairs enough to give the components of all of them.

    Each class is compared with the first of its bands' lists; only pairs of a list that this has left in
    different components are compared further. A large group of near copies so costs a comparison a
    copy, not one a pair.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    n, near = cut_by or cut_for(most, classes.count())
    lists = classes.select(named.alias("_l"), F.col("rep").alias("_rep"), F.col(hash_).alias("_h"), F.explode(bands(F.col(hash_), n, near)).alias("_x"))
    heads = cut(lists.groupBy("_l", "_x").agg(F.min(F.struct("_rep", "_h")).alias("_head"), F.count(F.lit(1)).alias("_c")).where("_c > 1"), "heads")
    heads = counted(heads)
    met = cut(lists.join(heads, (lists["_l"] == heads["_l"]) & (lists["_x"] == heads["_x"])).select(lists["_l"], lists["_x"], "_rep", "_h", "_head"), "lists")
    star = met.where((F.col("_rep") != F.col("_head._rep")) & (hamming(F.col("_h"), F.col("_head._h")) <= most)).select(F.col("_head._rep").alias("rep_a"), F.col("_rep").alias("rep_b")).distinct()
    star = cut(star, "star")
    found = components(star.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    met = cut(met.drop("_head").join(counted(found), F.col("_rep") == F.col("node"), "left").withColumn("_c", F.coalesce("component", "_rep")).drop("node", "component"), "labelled")
    mixed = cut(met.groupBy("_l", "_x").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).where("_lo <> _hi").select("_l", "_x"), "mixed")
    met = met.join(counted(mixed), ["_l", "_x"], "left_semi")
    other = met.select("_l", "_x", F.col("_rep").alias("_rep2"), F.col("_h").alias("_h2"), F.col("_c").alias("_c2"))
    more = met.join(shuffled(other), ["_l", "_x"]).where((F.col("_rep") < F.col("_rep2")) & (F.col("_c") != F.col("_c2")) & (hamming(F.col("_h"), F.col("_h2")) <= most))
    return star.union(more.select(F.col("_rep").alias("rep_a"), F.col("_rep2").alias("rep_b")).distinct())


def clusters(df: DataFrame, classes: DataFrame, pairs: DataFrame, label: str, order: str, hash_: str = "hash") -> DataFrame:
    """``df`` with ``component`` (its first row's order) and ``cluster_id``: label and number by first appearance.

    Numbers come from one row a cluster, dealt by range, so neither a label's members nor its clusters meet in one task.
    """
    found = components(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    reps = classes.join(counted(found), F.col("rep") == F.col("node"), "left").select(F.col(label).alias("_l"), F.col(hash_).alias("_h"), F.coalesce("component", "rep").alias("component"))
    firsts = numbered(reps.select(F.col("_l").alias("_fl"), F.col("component").alias("_c")).distinct(), ["_fl", "_c"], "_at")
    firsts = cut(firsts, "firsts")
    begins = firsts.groupBy(F.col("_fl").alias("_bl")).agg(F.min("_at").alias("_begin"))
    firsts = firsts.join(begins, F.col("_fl").eqNullSafe(F.col("_bl")))
    firsts = firsts.select("_c", F.concat_ws("_", F.col("_fl"), (F.col("_at") - F.col("_begin") + 1).cast("string")).alias("cluster_id"))
    named = reps.join(firsts, F.col("component") == F.col("_c")).drop("_c")
    return df.join(shuffled(named), F.col(label).eqNullSafe(F.col("_l")) & (F.col(hash_) == F.col("_h"))).drop("_l", "_h")


def choose(df: DataFrame, cluster: str, order: str, area: str, sharpness: str, cap: int = MAX_AUGMENTED, floor: float = SHARPNESS_FLOOR) -> DataFrame:
    """Add ``role``: unique, canonical, augmented or dropped.

    The canonical row has the largest area among those at least ``floor`` times as sharp as
    the sharpest (all, if nothing is sharp or no sharpness is known), ties to the first; of the others the
    first ``cap`` in order are augmented. A null cluster is a cluster like others; no row is lost.
    """
    best = df.groupBy(cluster).agg(F.coalesce(F.max(sharpness), F.lit(0)).alias("_top"), F.count(F.lit(1)).alias("_n"))
    d = same_keys(df, shuffled(best), [cluster])
    fit = (F.col("_top") <= 0) | F.coalesce(F.col(sharpness) >= floor * F.col("_top"), F.lit(False))
    pick = d.where(fit).groupBy(cluster).agg(F.max(F.struct(F.coalesce(area, F.lit(0)).alias("a"), (-F.col(order)).alias("o"))).alias("_p"))
    d = same_keys(d, shuffled(pick.select(cluster, (-F.col("_p.o")).alias("_canon"))), [cluster])
    canonical = F.col(order).eqNullSafe(F.col("_canon"))
    rest = d.where(~canonical)
    # the first rows of each slice of a cluster, then of these: a large cluster never meets in one task
    part = F.pmod(F.xxhash64(order), F.lit(SLICES))
    first = rest.select(F.col(cluster).alias("_fc"), F.col(order).alias("_fo"), part.alias("_part"))
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy("_fc", "_part").orderBy("_fo"))).where(F.col("_r") <= cap)
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy("_fc").orderBy("_fo"))).where(F.col("_r") <= cap)
    rest = rest.join(shuffled(first.select("_fc", "_fo")), F.col(cluster).eqNullSafe(F.col("_fc")) & (F.col(order) == F.col("_fo")), "left")
    rest = rest.withColumn("role", F.when(F.col("_fo").isNotNull(), "augmented").otherwise("dropped")).drop("_fc", "_fo")
    kept = d.where(canonical).withColumn("role", F.when(F.col("_n") == 1, "unique").otherwise("canonical"))
    return kept.unionByName(rest).drop("_top", "_n", "_canon")
