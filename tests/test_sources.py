import pytest
from pyspark.sql import functions as F

from sievework.functions import names
from sievework.operators import stats
from sievework.sources import files, infer, schemas, shared


def test_csv_keeps_quotes_backslashes_and_blanks(spark, tmp_path):
    rows = [("D:\\x\\a, b\\", "say \"hi\"", None), ("p", "q", "r")]
    df = spark.createDataFrame(rows, schemas.MANIFEST)
    files.write_csv(df.coalesce(1), f"file://{tmp_path}/t")
    assert sorted(files.read_csv(spark, f"file://{tmp_path}/t", schemas.MANIFEST).collect()) == sorted(df.collect())
    files.write_csv(df.where("false"), f"file://{tmp_path}/none")
    assert files.read_csv(spark, f"file://{tmp_path}/none", schemas.MANIFEST).count() == 0


def test_listing_keeps_empty_files_and_folders(spark, tmp_path):
    (tmp_path / "one/cats").mkdir(parents=True)
    (tmp_path / "one/none").mkdir()
    (tmp_path / "one/cats/a.JPG").write_bytes(b"x")
    (tmp_path / "one/cats/b.png").write_bytes(b"")
    (tmp_path / "one/cats/c.txt").write_bytes(b"y")
    df = files.list_folders(spark, {"s": str(tmp_path / "one"), "gone": str(tmp_path / "two")})
    good = names.allowed(F.col("name"))
    got = df.groupBy("dataset", "folder").agg(F.count_if(good).alias("n"), F.array_join(F.array_sort(F.collect_set(F.when(good, names.suffix(F.col("name"))))), "|").alias("kinds"), F.count_if(good & (F.coalesce("size", F.lit(0)) == 0)).alias("zero")).orderBy("folder").collect()
    assert [tuple(r) for r in got] == [("s", "cats", 2, ".jpg|.png", 1), ("s", "none", 0, "", 0)]


def test_listing_is_filtered_by_suffix_and_takes_odd_names(spark, tmp_path):
    root = f"file://{tmp_path}/my set"
    rows = [(f"{root}/a b/x %20.JPG", b"12"), (f"{root}/a b/y.png", None), (f"{root}/a b/z.txt", b"1"), (f"{root}/c/q.tar.gz", b"12345")]
    assert files.write_files(spark.createDataFrame(rows, "path string, content binary"), "path", "content") == 4
    (tmp_path / "my set/a b/deep.png").mkdir()
    got = files.list_folders(spark, {"s": root, "t": f"{tmp_path}/my set", "gone": "file:///no/such"}, (".jpg", ".png")).collect()
    want = [("a b", None, None), ("a b", "x %20.JPG", 2), ("a b", "y.png", 0), ("c", None, None)]
    for d in "st":
        assert sorted(((r["folder"], r["name"], r["size"]) for r in got if r["dataset"] == d), key=str) == sorted(want, key=str)
    assert len(got) == 8 and files.list_folders(spark, {"s": root}).count() == 6
    assert files.write_files(spark.createDataFrame([], "path string, content binary"), "path", "content") == 0


def test_types_in_any_partitioning(spark):
    data = [("1", "1.5", "TRUE", "2024-02-29", "1", None, " "), ("-2", "7", "false", " 2023-01-01 ", "x", None, ""), (None, "1e3", "", None, "2", None, None)]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, e string, f string, `g.h` string")
    want = {"a": ("long", 2, 1), "b": ("double", 3, 0), "c": ("boolean", 2, 1), "d": ("date", 2, 1), "e": ("string", 3, 0), "f": ("string", 0, 3), "g.h": ("string", 0, 3)}
    for n in (1, 3, 7):
        assert {r["name"]: (r["type"], r["filled"], r["blank"]) for r in infer.column_types(df.repartition(n)).collect()} == want
    out = infer.typed(df)
    assert [t for _, t in out.dtypes] == ["bigint", "double", "boolean", "date", "string", "string", "string"]
    assert [r["b"] for r in out.orderBy("b").collect()] == [1.5, 7.0, 1000.0]
    # no such day, a number too long, and numbers that only look like one
    odd = spark.createDataFrame([("2023-02-29", "1" * 25, "NaN", "0x1"), ("2023-02-28", "2", "1", "2")], "a string, b string, c string, d string")
    assert {r["name"]: r["type"] for r in infer.column_types(odd).collect()} == {"a": "string", "b": "double", "c": "string", "d": "string"}
    assert {r["type"] for r in infer.column_types(df.where("false")).collect()} == {"string"} and infer.typed(df.where("false")).count() == 0


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "t.csv").write_text('k,v\n1,a\n2\n3,b,c\nx,d\n4,"e, ""f"""\n"5,g\n,\n')
    good, bad = files.read_csv_apart(spark, f"file://{tmp_path}/t.csv", schemas._of(k=schemas._L, v=schemas._S))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "a"), (4, 'e, "f"'), (None, None)]
    assert sorted(r["line"] for r in bad.collect()) == ['"5,g', "2", "3,b,c", "x,d"]
    (tmp_path / "none.csv").write_text("k,v\n")
    assert [x.count() for x in files.read_csv_apart(spark, f"file://{tmp_path}/none.csv", schemas._of(k=schemas._L, v=schemas._S))] == [0, 0]


def test_names(spark):
    df = spark.createDataFrame([("a\\b/c.d.JPEG",), (".x",), ("DS7__q__aug1_c.png",), ("ds__q",)], "n string")
    n = F.col("n")
    got = df.select(names.basename(n), names.suffix(names.basename(n)), names.stem(n), names.dataset_code(n)).collect()
    assert [tuple(r) for r in got] == [("c.d.JPEG", ".jpeg", "c.d", "unknown"), (".x", "", ".x", "unknown"), ("DS7__q__aug1_c.png", ".png", "DS7__q__aug1_c", "DS7"), ("ds__q", "", "ds__q", "unknown")]


def test_flags_at_the_thresholds(spark):
    data = [("a", "x")] * 6 + [("a", "y")] * 4 + [("b", "x")] * 5 + [("b", "y")] * 5
    got = {r["label"]: (r["source"], r["flagged"]) for r in stats.source_concentration(spark.createDataFrame(data, "label string, source string"), "label", "source").collect()}
    assert got == {"a": ("x", True), "b": ("x", False)}


def test_skew_flags(spark):
    data = [("p", 60, 30, 10), ("q", 20, 40, 40), ("r", 10, 50, 40)]
    rows = [(k, v) for k, s, m, b in data for v in ["small"] * s + ["medium"] * m + ["large"] * b]
    df = spark.createDataFrame(rows, "label string, category string")
    got = {r["label"]: r["flagged"] for r in stats.skew(df, "label", F.col("category") == "small", 1.5, 0.05).collect()}
    assert got == {"p": True, "q": False, "r": False}
    assert "warning: p" in stats.health_report("t", {"largest": "p", "largest_n": 3, "smallest": "q", "smallest_n": 1, "ratio": 3.0}, [], ["p"])


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({k.replace("__", "."): v for k, v in conf.items()})


def test_the_shared_folder_must_be_named_on_a_cluster():
    assert shared.shared_dir(_Session(spark__master="spark://h:7077", spark__checkpoint__dir="hdfs://n/x/")) == "hdfs://n/x"
    for master in ("local", "local[4]"):
        assert shared.shared_dir(_Session(spark__master=master)).startswith("file://")
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="executors share"):
            shared.shared_dir(_Session(spark__master=master))


def test_batch_settings_are_put_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    with shared.arrow_rows(spark, 7):
        assert spark.conf.get(key) == "7"
    assert spark.conf.get(key) == old
