"""Sheets as text: a matrix whose header stands somewhere in the file, turned into long counts.

A file may be cut into splits that several tasks read. A line's place is its split's offset in the file
and its turn in the split, so the header is the first matching line of its file wherever that is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.names import tolerant_int

MARK = "Names of Breed"
#: More files than this are joined with their headers by a shuffle.
BROADCAST_FILES = 1 << 12


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, at``: ``at`` orders the lines of a file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"))
    return lines.select("file", F.col("value").alias("line"), F.struct(F.col("_start").alias("start"), F.monotonically_increasing_id().alias("turn")).alias("at"))


def fields(line: Column) -> Column:
    """The fields of a line of CSV, as many as it has; quoted ones may hold commas and doubled quotes."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    inner = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda x: F.when(x.startswith('"') & (F.length(x) > 1), inner(x)).otherwise(x))


def matrix_counts(spark: SparkSession, path: str, mark: str = MARK, column: int = 1) -> DataFrame:
    """``file, dataset, label, n`` of each sheet below ``path``.

    The header is the first line whose field ``column`` is ``mark``; lines before it don't count, and a file without
    one gives nothing. Fields of the header after that are dataset names; those under blank ones are left out.
    A line may have fewer fields than the header (the rest count 0) or more (they are left out). A blank label is no row; blank
    and unreadable counts are 0. Of a dataset and label that stand twice in a file, the later field counts.
    """
    lines = placed_lines(spark, path).withColumn("_f", fields(F.col("line")))
    head = lines.where(F.trim(F.get("_f", F.lit(column))) == mark).groupBy(F.col("file").alias("_file")).agg(F.min(F.struct("at", "_f")).alias("_h"))
    head = head.select("_file", F.col("_h.at").alias("_head_at"), F.slice("_h._f", column + 2, 1 << 20).alias("_names"))
    head = F.broadcast(head) if len(lines.inputFiles()) <= BROADCAST_FILES else head
    rows = lines.join(head, F.col("file") == F.col("_file")).where(F.col("at") > F.col("_head_at"))
    rows = rows.select("file", "at", F.trim(F.get("_f", F.lit(column))).alias("label"), F.posexplode("_names").alias("_i", "_name"), "_f")
    cells = rows.select("file", "label", F.trim("_name").alias("dataset"), tolerant_int(F.get("_f", F.col("_i") + column + 1)).alias("n"), F.struct("at", "_i").alias("_at"))
    cells = cells.where((F.col("dataset") != "") & (F.col("label") != ""))
    return cells.groupBy("file", "dataset", "label").agg(F.max_by("n", "_at").alias("n"))
