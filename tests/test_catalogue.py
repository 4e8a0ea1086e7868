"""Every curation query against its SQL counterpart on the smallest tables."""

import math
import random

import duckdb
import pytest

from sievework.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    rel = duck.sql(ORACLES[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(rel.columns) == columns
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)


def test_null_labels_and_short_texts_against_sql(spark, tmp_path):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(50)) for _ in range(60)) for _ in range(8)]
    texts = [b + f" tail{k}" for b in base for k in range(4)] + ["", None, " \t", "one", "one", "two words", "Two  words"] + base
    rows = [(i, t, [None, "en", "de"][i % 3 if i % 4 else 0], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(0, len(rows), 3)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for name in ("near_dup_pairs", "dup_clusters", "dedup_roles", "greedy_split", "iid_clients"):
        df, rel = QUERIES[name](spark, f"file://{tmp_path}"), con.sql(ORACLES[name])
        got = sorted((tuple(plain(r[c]) for c in rel.columns) for r in df.collect()), key=str)
        assert got == sorted((tuple(map(plain, r)) for r in rel.fetchall()), key=str)
        # no row is lost
        assert name == "near_dup_pairs" or len(got) == (len(rows) if name != "iid_clients" else sum(i % 10 < 8 for i in range(len(rows))))
    assert QUERIES["dirichlet_clients"](spark, f"file://{tmp_path}").count() == sum(i % 10 < 8 for i in range(len(rows)))


def test_vectors_of_any_width_against_sql(spark, tmp_path):
    rng = random.Random(2)
    base = [rng.uniform(-1, 1) for _ in range(100)]
    near = lambda n: [-x if rng.random() < 0.15 else x for x in base[:n]]
    rows = [(i, [None, "x", "y"][i % 3], near((64, 64, 64, 100, 3)[i % 5])) for i in range(120)]
    rows += [(120, "x", None), (140, None, []), (121, None, near(64)[::-1]), (160, "y", [None] * 64), (160, "y", near(64)), (None, "y", near(64))]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    df, rel = QUERIES["near_dup_mirror"](spark, f"file://{tmp_path}"), con.sql(ORACLES["near_dup_mirror"])
    got = sorted((tuple(plain(r[c]) for c in rel.columns) for r in df.collect()), key=str)
    assert got == sorted((tuple(map(plain, r)) for r in rel.fetchall()), key=str)
    assert {r[0] for r in got} == {None, "x", "y"} and any(r[1] == 140 for r in got)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
