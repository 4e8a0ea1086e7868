import hashlib

import pytest

from sievework.operators import stats
from sievework.sources import chunks, files, sheets, versions


def counts(spark, path):
    return sorted(((r["dataset"], r["label"], r["n"]) for r in sheets.matrix_counts(spark, path).collect()), key=str)


def test_the_header_is_found_wherever_its_split_is_read(spark, tmp_path):
    body = [f',"b, {i}",{i},x,{i + 1}' for i in range(3000)]
    text = ["notes", "", 'a,"Names of Breed, no",z', ',Names of Breed,d1,,"d ""2"""', *body, ",short,5", ",long,1,2,3,4,5", ",,7,7,7", ",gaps,_, ,?", ",Names of Breed,1,2,3", ',"b, 7",70'] + [f"p{i}" for i in range(50)]
    (tmp_path / "s.csv").write_text("\n".join(text) + "\n")
    (tmp_path / "none.csv").write_text("x,y\n,other,1\n")
    want = [(d, f"b, {i}", i + k if i != 7 else 70 * (1 - k)) for i in range(3000) for k, d in enumerate(("d1", 'd "2"'))]
    want += [("d1", "short", 5), ('d "2"', "short", 0), ("d1", "long", 1), ('d "2"', "long", 3), ("d1", "gaps", 0), ('d "2"', "gaps", 0), ("d1", "Names of Breed", 1), ('d "2"', "Names of Breed", 3)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert counts(spark, f"file://{tmp_path}") == sorted(want, key=str)
        assert sheets.placed_lines(spark, f"file://{tmp_path}/none.csv").count() == 2 and counts(spark, f"file://{tmp_path}/none.csv") == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def tree(data, block, fan):
    now = [hashlib.sha256(data[i : i + block]).digest() for i in range(0, max(1, len(data)), block)]
    while True:
        now = [hashlib.sha256(b"".join(now[i : i + fan])).digest() for i in range(0, len(now), fan)]
        if len(now) == 1:
            return now[0].hex()


def test_digests_do_not_depend_on_ranges(spark, tmp_path):
    data = {f"file://{tmp_path}/f/{n}": bytes(i * 7 % 251 for i in range(n)) for n in (0, 1, 99, 100, 101, 5000, 23_456)}
    files.write_files(spark.createDataFrame(list(data.items()), "path string, content binary"), "path", "content")
    listed = spark.createDataFrame([(p, len(d)) for p, d in data.items()] + [(None, 3)], "path string, size long")
    for at_once, parts in ((1, 1), (3, 5), (1000, 2)):
        got = {r["path"]: (r["digest"], r["blocks"]) for r in chunks.file_digests(listed.repartition(parts), "path", "size", 100, at_once, 4).collect()}
        assert {p: d for p, (d, _) in got.items()} == {p: tree(d, 100, 4) for p, d in data.items()}
        assert {p: b for p, (_, b) in got.items()} == {p: max(1, -(-len(d) // 100)) for p, d in data.items()}
    one = chunks.file_digests(listed.where("size = 101"), "path", "size", 100, 1, 4).first()
    assert one["digest"] == tree(data[f"file://{tmp_path}/f/101"], 100, 4)
    assert chunks.file_digests(listed.where("false"), "path", "size").count() == 0
    with pytest.raises(Exception, match="ends before"):
        chunks.file_digests(spark.createDataFrame([(f"file://{tmp_path}/f/99", 150)], "path string, size long"), "path", "size").collect()


def test_versions_are_seen_at_once_or_not(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.publish(spark.range(3), path) == 1
    assert versions.publish(versions.read(spark, path).where("id > 0"), path, replaces=1) == 2
    assert versions.read(spark, path).count() == 2 and versions.read(spark, path, 1).count() == 3
    # a writer that read version 1 is too late, and what it wrote isn't seen
    with pytest.raises(RuntimeError, match="meanwhile"):
        versions.publish(spark.range(9), path, replaces=1)
    assert versions.read(spark, path).count() == 2
    # one that dies before its mark leaves nothing to be seen
    spark.range(7).write.parquet(f"{path}/half")
    assert [n for n, _ in versions.versions(spark, path)] == [1, 2] and versions.publish(spark.range(0), path) == 3
    assert versions.read(spark, path).count() == 0


def test_report_figures():
    text = stats.health_report("t", {"largest": "p", "largest_n": 2, "smallest": "q", "smallest_n": 1, "ratio": 2.0}, [], [], [], [("q", 1, 1, 0), ("p", 2, 1, 1)])
    for line in ("- all: 3", "- mean per label: 1.5", "- real: 2 (66.7 %)", "| p | 2 | 66.7 % | 50.0 % | 50.0 % |", "| q | 1 | 33.3 % | 100.0 % | 0.0 % |"):
        assert line in text.split("\n")
    assert stats.tenths(1, 0) == "0.0" and stats.percent(1, 8) == "12.5 %" and stats.tenths(5, 100) == "0.1"
