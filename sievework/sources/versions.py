"""Tables that are rewritten as a whole: readers see a new version at once or not at all.

Each version is a folder of its own. It counts once its mark is there: an empty file that is created
under the next number only if no one else has created it, which file systems do in one step. What a version replaces stays, so it is a
snapshot to go back to, and a rewrite may read what it replaces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the published versions, oldest first."""
    fs, marks = _fs(spark, f"{path}/marks")
    if not fs.exists(marks):
        return []
    return sorted((int(n), f"{path}/{folder}") for n, folder in (s.getPath().getName().split("-", 1) for s in fs.listStatus(marks)))


def publish(df: DataFrame, path: str, replaces: int | None = None) -> int:
    """Write ``df`` as the next version and return its number.

    ``replaces`` is the version that was read (None: whatever is there). If another writer has published since, this one
    fails, and its folder is never seen.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    before = versions(spark, path)
    last = before[-1][0] if before else 0
    df.write.parquet(f"{path}/{folder}")
    if replaces is not None and (now := [n for n, _ in versions(spark, path)][-1:]) != ([replaces] if replaces else []):
        raise RuntimeError(f"version {replaces} was replaced by {now} meanwhile")
    number = (replaces if replaces is not None else last) + 1
    fs, locks = _fs(spark, f"{path}/numbers/{number}")
    # the one step that decides: creating the number's file fails if it is there
    if fs.exists(locks) or not fs.createNewFile(locks):
        raise RuntimeError(f"version {number} was published by another writer")
    fs, mark = _fs(spark, f"{path}/marks/{number}-{folder}")
    fs.create(mark, True).close()
    return number


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The latest version, or that of a number."""
    there = dict(versions(spark, path))
    if not there or (number is not None and number not in there):
        raise FileNotFoundError(f"no version {number or ''} of {path}")
    return spark.read.parquet(there[number or max(there)])
