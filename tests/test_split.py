from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.operators import dedup, federate, reconcile, split
from sievework.sources.schemas import SPLIT_SHARES


def one_by_one(targets, filled, size, m):
    taken = [0] * len(targets)
    for _ in range(m):
        i = min((i for i, t in enumerate(targets) if t > 0), key=lambda i: ((filled[i] + taken[i] * size) / targets[i], i))
        taken[i] += 1
    return taken


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=2, max_size=8), st.data())
def test_a_run_is_filled_as_one_by_one(shares, data):
    total = data.draw(st.integers(10, 5000))
    targets = [total * s / sum(shares) for s in shares]
    filled = [data.draw(st.integers(0, int(t) + 3)) for t in targets]
    size, m = data.draw(st.integers(1, 7)), data.draw(st.integers(0, 400))
    assert split.fill(targets, filled, size, m) == one_by_one(targets, filled, size, m)


def rows(spark, n=900):
    k = F.col("id")
    return spark.range(n).select(k.alias("ord"), F.when(k % 3 == 0, "a").otherwise("b").alias("label"), (k % 7 == 0).alias("flag"), F.concat(F.lit("c"), F.floor(k / (1 + k % 4)).cast("string")).alias("cluster_key"))


def test_split_keeps_clusters_and_rows(spark):
    out = split.split(rows(spark), ["label", "flag"], "cluster_key", list(SPLIT_SHARES)).cache()
    assert out.count() == 900 and out.select("ord").distinct().count() == 900
    assert out.groupBy("label", "flag", "cluster_key").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert abs(n["train"] - 720) < 30


def test_split_does_not_depend_on_the_layout(spark):
    a = split.split(rows(spark), ["label"], "cluster_key", list(SPLIT_SHARES)).select("ord", "split")
    b = split.split(rows(spark).repartition(7, "ord"), ["label"], "cluster_key", list(SPLIT_SHARES)).select("ord", "split")
    assert a.exceptAll(b).count() == 0


def test_repair_votes(spark):
    data = [(1, "x", "val"), (2, "x", "train"), (3, "y", "val"), (4, "y", "test"), (5, "z", "test"), (6, "z", "test"), (7, "z", "train")]
    df = spark.createDataFrame(data, "ord int, cluster_key string, split string")
    fixed = split.repair(df, "cluster_key")
    assert {(r["cluster_key"], r["new_split"]) for r in fixed.collect()} == {("x", "train"), ("y", "test"), ("z", "test")}
    assert split.violations(fixed, "cluster_key", "new_split").count() == 0


def test_clients_get_all_rows(spark):
    out = federate.assign(rows(spark), "label", "cluster_key", lambda c, label, n: federate.dirichlet_targets(c, label, n, 5))
    assert out.count() == 900


def test_dirichlet_shares_have_the_right_moments(spark):
    labels = spark.range(4000).select(F.concat(F.lit("l"), "id").alias("label"))
    got = [r["shares"] for r in federate.dirichlet_shares(labels, "label", 4, 0.5, 0.0).select("shares").collect()]
    assert all(abs(sum(s) - 1) < 1e-9 for s in got)
    mean, square = sum(s[0] for s in got) / 4000, sum(s[0] ** 2 for s in got) / 4000
    # Dirichlet(0.5 x 4): mean 1/4, second moment 0.5 * 1.5 / (2 * 3)
    assert abs(mean - 0.25) < 0.02 and abs(square - 0.125) < 0.012
    again = federate.dirichlet_shares(labels.repartition(7), "label", 4, 0.5, 0.0)
    assert again.join(federate.dirichlet_shares(labels, "label", 4, 0.5, 0.0).withColumnRenamed("shares", "s2"), "label").where("shares <> s2").count() == 0
    odd = spark.createDataFrame([(None,), ("a",)], "label string")
    for s in federate.dirichlet_shares(odd, "label", 10).collect():
        assert abs(sum(s["shares"]) - 1) < 1e-9 and min(s["shares"]) > 0.01
    assert federate.dirichlet_shares(odd.where("false"), "label", 3).count() == 0
    big = [r["shares"] for r in federate.dirichlet_shares(labels, "label", 3, 30.0, 0.0).limit(500).collect()]
    assert max(max(s) for s in big) < 0.6


def test_prefix_join_of_many_stems_of_one_letter(spark):
    n = 100_000
    files = spark.range(n).select(F.col("id").alias("ord"), F.concat(F.lit("d/a"), F.col("id").cast("string"), F.lit(".png")).alias("path"))
    tops = spark.range(0, n, 1000).select((F.col("id") + n).alias("ord"), F.concat(F.lit("d/a"), F.col("id").cast("string"), F.lit("__topup1_0.png")).alias("path"))
    odd = spark.createDataFrame([(-1, "d/a9999999__topup1_1.png"), (-2, "e/a1__topup1_1.png"), (-3, "d/__topup1_1.png"), (-4, None)], "ord long, path string")
    marks = spark.createDataFrame([(1, "d/a1000.png", "c1")], "ord long, new_path string, cluster_id string")
    out = split.cluster_map(files.union(tops).union(odd), marks, "path", "ord")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" not in plan
    got = {r["ord"]: r["cluster_key"] for r in out.where("ord < 0 or ord >= 100000 or ord in (0, 1000, 2000, 3)").collect()}
    assert got[n + 1000] == "c1" and got[n + 2000] == "topup_d/a2000.png" == got[2000] and got[3] == "singleton_d/a3.png"
    # a root that no stem has, one of another folder, an empty root that every stem begins with
    assert got[-1] == "singleton_d/a9999999__topup1_1.png" and got[-2] == "singleton_e/a1__topup1_1.png" and got[-3] == "topup_d/a0.png" and got[-4] is None


def test_null_keys_lose_no_rows(spark):
    votes = spark.createDataFrame([(1, None, "val"), (2, None, "val"), (3, None, "train"), (4, "x", None)], "ord int, cluster_key string, split string")
    assert sorted((r["ord"], r["new_split"]) for r in split.repair(votes, "cluster_key").collect()) == [(1, "val"), (2, "val"), (3, "val"), (4, None)]
    rows_ = spark.createDataFrame([(i, None if i > 6 else "c" + str(i // 3), 5, None if i < 3 else float(i)) for i in range(10)], "ord int, c string, area int, sharp double")
    got = {r["ord"]: r["role"] for r in dedup.choose(rows_, "c", "ord", "area", "sharp", cap=1).collect()}
    assert len(got) == 10 and [got[i] for i in (0, 1, 2)] == ["canonical", "augmented", "dropped"] and got[6] == "unique" and got[7] == "canonical"
    a, b = (spark.createDataFrame(x, "s string, l string, n int") for x in ([("s", None, 3), ("t", "a", 1)], [("s", None, 3), (None, None, 2)]))
    assert [tuple(r) for r in reconcile.compare_counts(a, b, ["s", "l"], "n").orderBy("kind").collect()] == [(None, None, None, 2, None, "excel_only"), ("t", "a", 1, None, None, "script_only")]
    k = lambda *x: spark.createDataFrame([(v,) for v in x], "k string")
    assert [tuple(r) for r in reconcile.change_sets(k(None, "a"), k(None, "b"), k(), "k").orderBy("k").collect()] == [("a", "added_discovered_on_disk"), ("b", "removed_missing_from_disk")]
    kept = reconcile.quarantine(k(None, "a", "b"), k(None, "b"), "k")
    assert [sorted((r["k"] or "") for r in x.collect()) for x in kept] == [["", "b"], ["a"]]


def test_clients_are_counted_as_they_are_written(spark, tmp_path):
    data = [(0, "a", "x\\y/f1.png"), (0, None, "f2"), (2, "a", None), (None, "b", "q/f3")]
    df = spark.createDataFrame(data, "client_id int, label string, path string")
    got = federate.write_clients(df, "label", f"file://{tmp_path}/c", 3, "path")
    assert sorted(map(tuple, got.collect()), key=str) == [(0, 2), (1, 0), (2, 1), (None, 1)]
    there = spark.read.parquet(f"file://{tmp_path}/c")
    assert sorted((r["path"] or "") for r in there.collect()) == ["", "b/f3", "client_0/a/f1.png", "client_0/unknown/f2"]
    assert federate.write_clients(df.where("false"), "label", f"file://{tmp_path}/none", 2).count() == 2


def test_clients_get_rows_with_null_labels_and_clusters(spark):
    odd = rows(spark, 90).withColumn("label", F.when(F.col("ord") % 3 > 0, F.col("label"))).withColumn("cluster_key", F.when(F.col("ord") % 5 > 0, F.col("cluster_key")))
    for targets in (federate.dirichlet_targets, federate.iid_targets):
        out = federate.assign(odd, "label", "cluster_key", lambda c, label, n, t=targets: t(c, label, n, 5))
        assert sorted(r["ord"] for r in out.collect()) == list(range(90))
