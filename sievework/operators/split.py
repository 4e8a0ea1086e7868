"""Splits that keep clusters whole, and the repair of those that don't.

Clusters go smallest first to the bin that is least filled for its target, ties to the first bin.
Clusters of one size are alike but for a seeded order, so the fold runs over the distinct sizes of
a stratum, with a count each, and takes a whole count in one step; the members of a size are then
dealt to bins by rank. No stratum's clusters ever meet in one task.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.names import blank_as_null, parent, stem
from sievework.operators.joins import same_keys, shuffled
from sievework.sources.shared import cut


#: More folders than this are joined by a shuffle.
BROADCAST_FOLDERS = 1 << 16


def fill(targets: list[float], filled: list[int], size: int, m: int) -> list[int]:
    """How many of ``m`` clusters of one size each bin gets, one after another to the least filled/target.

    The picks of a bin have an arithmetic progression of keys, so all but a few of them follow from
    a common level; the last ones are made one by one.
    """
    bins = [i for i, t in enumerate(targets) if t > 0]
    if not bins:
        return [m] + [0] * (len(targets) - 1)
    taken = [0] * len(targets)
    sure = m - len(bins)
    if sure > 2 * len(bins):
        level, open_ = 0.0, sorted(bins, key=lambda i: filled[i] / targets[i])
        for k in range(1, len(open_) + 1):
            use = open_[:k]
            level = (sure * size + sum(filled[i] for i in use)) / sum(targets[i] for i in use)
            if k == len(open_) or level <= filled[open_[k]] / targets[open_[k]]:
                break
        for i in bins:
            taken[i] = max(0, math.floor((level * targets[i] - filled[i]) / size) - 1)
    for _ in range(m - sum(taken)):
        i = min(bins, key=lambda i: ((filled[i] + taken[i] * size) / targets[i], i))
        taken[i] += 1
    return taken


def seeded(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def allot(clusters: DataFrame, strata: list[str], key: str, size: str, targets: DataFrame, seed: int = 42) -> DataFrame:
    """``strata, key, size, bin``. ``targets`` has ``strata, bins array<string>, goals array<double>``, a row a stratum."""
    c = clusters.select(*strata, key, F.col(size).cast("long").alias("_size")).withColumn("_o", seeded(F.col(key), seed))
    runs = c.groupBy(*strata, "_size").agg(F.count(F.lit(1)).alias("_m"))
    goal = targets.select(*[F.col(s).alias(f"_t_{s}") for s in strata], "bins", "goals")
    on = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"_t_{s}")) for s in strata])
    runs = runs.join(goal, on).drop(*[f"_t_{s}" for s in strata])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.select(*strata).schema)

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_size")
        goals, bins = list(rows["goals"].iloc[0]), list(rows["bins"].iloc[0])
        filled, out = [0] * len(goals), []
        for n, (s, m) in enumerate(zip(rows["_size"], rows["_m"], strict=True)):
            took, at = fill(goals, filled, int(s), int(m)), 0
            for i, k in enumerate(took):
                filled[i] += k * int(s)
                if k:
                    out.append((*rows[strata].iloc[n], int(s), bins[i], at, at + k))
                at += k
        return pd.DataFrame(out, columns=[*strata, "_size", "bin", "_from", "_to"])

    # one row for each distinct cluster size of a stratum
    dealt = runs.groupBy(*strata).applyInPandas(fold, f"{fields}, _size long, bin string, _from long, _to long")
    # rank within a size: counts of hash slices before, and a rank inside the slice
    part = F.substring("_o", 1, 3)
    slices = c.groupBy(*strata, "_size", part.alias("_part")).agg(F.count(F.lit(1)).alias("_k"))
    before = Window.partitionBy(*strata, "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*[F.col(s).alias(f"_s_{s}") for s in strata], F.col("_size").alias("_s_size"), "_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"))
    same = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"_s_{s}")) for s in strata])
    c = c.withColumns({"_p": part, "_in": F.row_number().over(Window.partitionBy(*strata, "_size", part).orderBy("_o", key)) - 1})
    c = c.join(slices, same & (F.col("_size") == F.col("_s_size")) & (F.col("_p") == F.col("_part"))).withColumn("_rank", F.col("_before") + F.col("_in"))
    d = dealt.select(*[F.col(s).alias(f"_d_{s}") for s in strata], F.col("_size").alias("_d_size"), "bin", "_from", "_to")
    mine = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"_d_{s}")) for s in strata])
    hit = mine & (F.col("_size") == F.col("_d_size")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return c.join(d, hit).select(*strata, key, F.col("_size").alias(size), "bin")


def share_targets(clusters: DataFrame, strata: list[str], size: str, shares: list[tuple[str, float]]) -> DataFrame:
    """Targets of a stratum's total times fixed shares."""
    total = clusters.groupBy(*strata).agg(F.sum(size).alias("_t"))
    return total.select(*strata, F.array(*[F.lit(k) for k, _ in shares]).alias("bins"), F.array(*[F.col("_t") * F.lit(float(s)) for _, s in shares]).alias("goals"))


def split(rows: DataFrame, strata: list[str], cluster: str, shares: list[tuple[str, float]], seed: int = 42) -> DataFrame:
    """``rows`` with ``split``; a cluster is whole within each stratum."""
    c = rows.groupBy(*strata, cluster).agg(F.count(F.lit(1)).alias("_n"))
    found = allot(c, strata, cluster, "_n", share_targets(c, strata, "_n", shares), seed).drop("_n")
    found = found.select(*[F.col(x).alias(f"_a_{x}") for x in [*strata, cluster]], F.col("bin").alias("split"))
    on = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"_a_{x}")) for x in [*strata, cluster]])
    return rows.join(shuffled(found), on).drop(*[f"_a_{x}" for x in [*strata, cluster]])


def cluster_map(rows: DataFrame, clusters: DataFrame, path: str, order: str) -> DataFrame:
    """``rows`` with ``cluster_key``: the path's cluster, that of the source of a top-up, or a cluster of its own.

    ``clusters`` has ``new_path, cluster_id`` and an order, of which the last row of a path counts. A top-up's
    source is the file of its folder whose stem begins its name: an equal stem first, then the shortest, then
    by name. A source without a cluster gives one name to both.
    """
    c = clusters.where(blank_as_null(F.col("new_path")).isNotNull()).groupBy("new_path").agg(F.max_by("cluster_id", order).alias("_own"))
    base = rows.join(c, F.col(path) == F.col("new_path"), "left").drop("new_path")
    base = base.withColumns({"_dir": parent(F.col(path)), "_stem": stem(F.col(path))})
    top = base.where(F.col("_stem").contains("__topup")).select(F.col(path).alias("_tp"), "_dir", F.split_part("_stem", F.lit("__topup"), F.lit(1)).alias("_root"))
    plain = base.where(~F.col("_stem").contains("__topup") & ~F.col("_stem").contains("__aug"))
    # each plain stem is cut at the lengths that roots of its folder have: a join on equal prefixes, of which only the best source is kept
    lengths = cut(top.groupBy(F.col("_dir").alias("_ld")).agg(F.collect_set(F.length("_root")).alias("_lengths")), "root-lengths")
    lengths = F.broadcast(lengths) if lengths.count() <= BROADCAST_FOLDERS else lengths
    fits = F.filter("_lengths", lambda n: n <= F.length("_stem"))
    plain = plain.join(lengths, F.col("_dir") == F.col("_ld")).select("_dir", "_stem", F.col(path).alias("_sp"), F.col("_own").alias("_sc"), F.explode(fits).alias("_n"))
    best = plain.groupBy(F.col("_dir").alias("_sd"), F.substring("_stem", F.lit(1), F.col("_n")).alias("_prefix")).agg(F.min(F.struct(F.length("_stem").alias("_l"), "_sp", "_sc")).alias("_b"))
    found = top.join(best, (F.col("_dir") == F.col("_sd")) & (F.col("_root") == F.col("_prefix"))).select("_tp", F.col("_b._sp").alias("_source"), F.col("_b._sc").alias("_scluster"))
    out = base.join(found, F.col(path) == F.col("_tp"), "left").drop("_tp")
    made = F.concat(F.lit("topup_"), F.col("_source"))
    sources = found.where("_scluster is null").select(F.col("_source").alias("_used")).distinct()
    out = out.join(sources, F.col(path) == F.col("_used"), "left")
    of_source = F.when(F.col("_used").isNotNull(), F.concat(F.lit("topup_"), F.col(path)))
    key = F.coalesce("_own", F.when(F.col("_source").isNotNull(), F.coalesce("_scluster", made)), of_source, F.concat(F.lit("singleton_"), F.col(path)))
    return out.withColumn("cluster_key", key).drop("_own", "_dir", "_stem", "_source", "_scluster", "_used")


def violations(rows: DataFrame, cluster: str, split_: str = "split") -> DataFrame:
    """Clusters that stand in several splits."""
    return rows.groupBy(cluster).agg(F.countDistinct(split_).alias("splits"), F.count(F.lit(1)).alias("n")).where("splits > 1")


def repair(rows: DataFrame, cluster: str, split_: str = "split") -> DataFrame:
    """Add ``new_split``: a split cluster goes where most of its rows are; ties to train, then by name. A null cluster is one like others."""
    votes = rows.groupBy(cluster, split_).agg(F.count(F.lit(1)).alias("_n"))
    best = votes.groupBy(cluster).agg(F.min(F.struct((-F.col("_n")).alias("n"), (F.col(split_) != "train").alias("t"), F.col(split_).alias("s"))).alias("_b"))
    return same_keys(rows, shuffled(best.select(cluster, F.col("_b.s").alias("new_split"))), [cluster])
