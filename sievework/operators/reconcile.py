"""Comparing two accounts of one collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.joins import same_keys


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: that with the largest ``order``."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def compare_counts(scripted: DataFrame, manual: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``keys, scripted, manual, diff, kind`` of what disagrees.

    A count that one side lacks is only reported if the other's isn't 0; two unequal counts are a
    mismatch, even if one is 0. Null keys are keys like others.
    """
    a = scripted.select(*keys, F.col(count).cast("long").alias("scripted"))
    b = manual.select(*keys, F.col(count).cast("long").alias("manual"))
    both = same_keys(a, b, keys, "full")
    kind = (
        F.when(F.col("scripted").isNull() & (F.col("manual") != 0), "excel_only")
        .when(F.col("manual").isNull() & (F.col("scripted") != 0), "script_only")
        .when(F.col("scripted") != F.col("manual"), "mismatch")
    )
    return both.select(*keys, "scripted", "manual", (F.col("scripted") - F.col("manual")).alias("diff"), kind.alias("kind")).where("kind is not null")


def swapped(differences: DataFrame, manual: DataFrame, dataset: str, label: str, count: str) -> DataFrame:
    """Mismatches whose scripted count is another label's manual count in the same dataset; each unordered pair once."""
    m = manual.select(F.col(dataset).alias("_d"), F.col(label).alias("other"), F.col(count).cast("long").alias("_n"))
    found = differences.where("kind = 'mismatch'").join(m, (F.col(dataset) == F.col("_d")) & (F.col("scripted") == F.col("_n")) & (F.col(label) != F.col("other")) & (F.col("_n") != 0))
    pairs = found.select(F.col(dataset), F.least(label, "other").alias("label_a"), F.greatest(label, "other").alias("label_b"), F.col("scripted").alias("n"))
    return pairs.groupBy(dataset, "label_a", "label_b").agg(F.min("n").alias("n"))


def change_sets(disk: DataFrame, manifest: DataFrame, corrupt: DataFrame, key: str) -> DataFrame:
    """``key, change``: added on disk, removed from it, or corrupt. A key may be listed for two reasons; null is a key like others."""
    seen = disk.select(key).union(corrupt.select(key)).distinct()
    listed = manifest.select(key).distinct()
    tag = lambda df, what: df.select(key, F.lit(what).alias("change"))
    parts = [
        tag(same_keys(seen, listed, [key], "left_anti"), "added_discovered_on_disk"),
        tag(same_keys(listed, seen, [key], "left_anti"), "removed_missing_from_disk"),
        tag(corrupt.select(key).distinct(), "corrupt_kept_in_metadata_excluded_from_manifest"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def quarantine(rows: DataFrame, flagged: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(flagged rows, the others)."""
    ids = flagged.select(key).distinct()
    return same_keys(rows, ids, [key], "left_semi"), same_keys(rows, ids, [key], "left_anti")


def move_log(rows: DataFrame, listing: DataFrame, path: str, new_path: str) -> DataFrame:
    """Add ``moved`` (whether the path is listed) and blank the new path of what wasn't."""
    there = listing.select(F.col(path).alias("_p")).distinct().withColumn("moved", F.lit(True))
    out = rows.join(there, F.col(path) == F.col("_p"), "left").drop("_p").withColumn("moved", F.coalesce("moved", F.lit(False)))
    return out.withColumn(new_path, F.when(F.col("moved"), F.col(new_path)).otherwise(F.lit("")))


def move_counts(log: DataFrame, by: list[str]) -> DataFrame:
    """``by, level, moved, missing`` of a move log, by group and in all."""
    return log.rollup(*by).agg(F.grouping_id().cast("long").alias("level"), F.count_if("moved").alias("moved"), F.count_if(~F.col("moved")).alias("missing"))


def copy_plan(rows: DataFrame, existing: DataFrame, target: str) -> DataFrame:
    """Add ``action``: skip what exists, copy the rest; both stay listed."""
    there = existing.select(F.col(target).alias("_t")).distinct().withColumn("_there", F.lit(True))
    return rows.join(there, F.col(target) == F.col("_t"), "left").withColumn("action", F.when(F.col("_there"), "skip").otherwise("copy")).drop("_t", "_there")


def first_found(rows: DataFrame, listing: DataFrame, candidates: list[str], path: str, out: str) -> DataFrame:
    """The first of a row's candidate paths that is listed, else its last candidate."""
    names = listing.select(path).distinct()
    found = rows
    for i, c in enumerate(candidates):
        found = found.join(names.select(F.col(path).alias(f"_f{i}")), F.col(c) == F.col(f"_f{i}"), "left")
    return found.withColumn(out, F.coalesce(*[f"_f{i}" for i in range(len(candidates))], candidates[-1])).drop(*[f"_f{i}" for i in range(len(candidates))])


def ranked(df: DataFrame, group: list[str], order: list, out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
