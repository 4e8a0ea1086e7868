from pyspark.sql import functions as F

from sievework.operators import access


def files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numFiles").value()


def test_a_batch_reads_only_its_files(spark, tmp_path):
    path = f"file://{tmp_path}/i"
    items = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(5).alias("index"), F.lit("x").alias("part"))
    access.write_index(items, ["k"], path, per_file=100)
    got = access.items_at(spark, path, [3, 250, 3, 299, 5000, -1])
    assert sorted(map(tuple, got.collect())) == [(3, 3), (250, 250), (299, 299)]
    assert files_read(got.coalesce(1)) == 2
    whole = spark.read.parquet(f"{path}/items")
    assert whole.count() == 1000 and files_read(whole) == 10
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.where("index in (3, 250, 299, 5000)").select("k", "index").collect()))
    asked = spark.createDataFrame([(3, "a"), (3, "b"), (999, "c"), (None, "d"), (4000, "e")], "at long, note string")
    assert sorted(map(tuple, access.items_of(spark, path, asked, "at").collect())) == [(3, "a", 3), (3, "b", 3), (999, "c", 999)]


def test_an_index_of_nothing_and_subsets(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    access.write_index(spark.createDataFrame([], "k long"), ["k"], path)
    assert access.items_at(spark, path, [0, 1]).count() == 0
    assert access.items_of(spark, path, spark.range(3).toDF("index")).count() == 0
    rows = spark.createDataFrame([(1, "Train", 0), (2, "val", 1), (3, None, None)], "k int, split string, client_id int")
    keys = lambda df: sorted(r["k"] for r in df.collect())
    assert keys(access.subset(rows, "TRAIN")) == [1] and keys(access.subset(rows, client=1)) == [2] and keys(access.subset(rows)) == [1, 2, 3]
    assert keys(access.subset(rows.select("k"), "train", 4)) == [1, 2, 3]
