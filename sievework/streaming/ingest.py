"""Incremental ingestion: new files are read as a stream and copies of known content are left out.

A null content is an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sievework.operators.joins import same_keys
from sievework.sources.shared import exists


def stream(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_of_content(rows: DataFrame, content: str, time: str, delay: str = "1 day") -> DataFrame:
    """One row of each content among those that arrive within ``delay`` of one another; state older than that goes."""
    keyed = rows.withColumn("content_hash", F.sha2(F.coalesce(content, F.lit("")), 256))
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def counts_by_window(rows: DataFrame, time: str, by: str, length: str, delay: str) -> DataFrame:
    """Rows of each value of ``by`` in each window of event time; late rows within ``delay`` still count."""
    return rows.withWatermark(time, delay).groupBy(F.window(time, length), by).agg(F.count(F.lit(1)).alias("n"))


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet once for each input, with what is there now; a restart goes on after the last batch."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def commit_batch(rows: DataFrame, batch: int, path: str, content: str, order: str) -> None:
    """Add one batch to the table of first rows below ``path``; the same batch again gives the same files.

    Digests that earlier batches have committed are a table of their own, with the smallest order seen; it
    has no watermark and holds no texts. Of this batch, rows whose content is new, or stands before the
    row that is known, are written; then their digests; then the mark that makes both visible. A batch that was cut off before
    its mark is written over when the stream hands it out again.
    """
    spark = rows.sparkSession
    digest = F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("")), 256)
    keyed = rows.withColumn("content_hash", digest)
    first = keyed.groupBy("content_hash").agg(F.min(order).alias(order))
    if exists(spark, f"{path}/digests"):
        known = spark.read.parquet(f"{path}/digests").where(F.col("batch") < batch).select(F.col("content_hash").alias("_hash"), F.col(order).alias("_known"))
        known = known.join(first.select("content_hash"), F.col("_hash") == F.col("content_hash"), "left_semi").groupBy("_hash").agg(F.min("_known").alias("_known"))
        earlier = F.col(order).isNotNull() & (F.col("_known").isNull() | (F.col(order) < F.col("_known")))
        first = first.join(known, F.col("content_hash") == F.col("_hash"), "left").where(F.col("_hash").isNull() | earlier).select("content_hash", order)
    at = f"batch={batch}"
    fresh = f"{path}/fresh/{at}"
    first.write.mode("overwrite").parquet(fresh)
    first = spark.read.parquet(fresh)
    same_keys(keyed, first, ["content_hash", order]).dropDuplicates(["content_hash", order]).write.mode("overwrite").parquet(f"{path}/rows/{at}")
    first.write.mode("overwrite").option("parquet.bloom.filter.enabled#content_hash", "true").parquet(f"{path}/digests/{at}")
    first.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/commits/{at}")


def keep_first(rows: DataFrame, path: str, checkpoint: str, content: str, order: str) -> StreamingQuery:
    """Ingest what a stream has now into the table of first rows below ``path``; a restart goes on after the last committed batch."""
    put = lambda batch_rows, batch: commit_batch(batch_rows, batch, path, content, order)
    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_rows(spark: SparkSession, path: str, order: str) -> DataFrame:
    """The first row of each content, by ``order``, of all committed batches, whatever the order of arrival; null orders come last."""
    done = spark.read.parquet(f"{path}/commits").select("batch").distinct()
    rows = spark.read.parquet(f"{path}/rows").join(F.broadcast(done), "batch", "left_semi").drop("batch")
    digests = spark.read.parquet(f"{path}/digests").join(F.broadcast(done), "batch", "left_semi")
    return same_keys(rows, digests.groupBy("content_hash").agg(F.min(order).alias(order)), ["content_hash", order])
