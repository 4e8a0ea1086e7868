"""Tables in the folder that all executors share, which cut a query's lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a new one of our own only in a local session where that is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset; on a cluster it must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="sievework-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/sievework/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, so that later jobs start there."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once nothing that is still to run reads them."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Bound the rows of Arrow batches for what is run inside; then the setting is what it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the row's place from 0 in the order of ``order``, which must be total.

    Rows are dealt by range; only the ranges' sizes, one row a partition, are summed in one place.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = cut(ranged, "ranged")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(starts, "_range").withColumn(name, F.col("_start") + inside - 1).drop("_range", "_start")
