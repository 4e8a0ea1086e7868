import datetime as dt

from sievework.streaming import ingest

SCHEMA = "id long, text string, kind string, at timestamp"


def test_copies_are_left_out_and_a_restart_goes_on(spark, tmp_path):
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))
    t = dt.datetime(2024, 1, 1)
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    run = lambda: ingest.append_to(ingest.first_of_content(ingest.stream(spark, src, SCHEMA), "text", "at"), out, ck).awaitTermination(120)
    put([(1, "a", "x", t), (2, "a", "x", t), (3, "b", "y", t)])
    run()
    assert spark.read.parquet(out).count() == 2
    put([(4, "a", "x", t + dt.timedelta(hours=1)), (5, "c", "y", t), (6, None, "y", t)])
    run()
    assert sorted(r["text"] or "" for r in spark.read.parquet(out).collect()) == ["", "a", "b", "c"]


def test_windows(spark, tmp_path):
    src = f"file://{tmp_path}/in"
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, "a", "xy"[i % 2], t + dt.timedelta(minutes=i)) for i in range(30)], SCHEMA).write.parquet(src)
    counts = ingest.counts_by_window(ingest.stream(spark, src, SCHEMA), "at", "kind", "10 minutes", "1 minute")
    q = counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r["kind"], r["n"]) for r in spark.table("windows").collect()) == [("x", 5)] * 3 + [("y", 5)] * 3


def first_rows(spark, out):
    return sorted((r["id"], r["text"]) for r in ingest.first_rows(spark, out, "id").collect())


def test_first_rows_survive_a_batch_that_is_cut_off(spark, tmp_path, monkeypatch):
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    t = dt.datetime(2024, 1, 1)
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    run = lambda: ingest.keep_first(ingest.stream(spark, src, SCHEMA, 1), out, f"{out}/checkpoint", "text", "id").awaitTermination(180)
    put([(5, "a", "x", t), (6, "a", "x", t), (7, None, "y", t), (8, "", "y", t)])
    run()
    assert first_rows(spark, out) == [(5, "a"), (7, None)]
    # content that is known, an earlier row of it, new content, a null id
    put([(9, "a", "x", t), (2, "a", "x", t), (10, "b", "y", t), (None, "c", "y", t)])
    whole = ingest.commit_batch

    def cut_off(rows, batch, path, content, order):
        whole(rows, batch, path, content, order)
        import shutil

        shutil.rmtree(f"{tmp_path}/out/commits/batch={batch}")
        raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest, "commit_batch", cut_off)
    try:
        run()
    except Exception as e:
        assert "executor lost" in str(e)
    # rows of a batch without its mark aren't seen
    assert first_rows(spark, out) == [(5, "a"), (7, None)]
    monkeypatch.setattr(ingest, "commit_batch", whole)
    run()
    want = [("2", "a"), ("7", None), ("10", "b"), ("None", "c")]
    assert sorted((str(r["id"]), r["text"]) for r in ingest.first_rows(spark, out, "id").collect()) == sorted(want)
    put([(11, "c", "x", t), (12, "d", "x", t)])
    put([(13, "d", "x", t), (1, "d", "x", t)])
    run()
    run()
    want = [("1", "d"), ("2", "a"), ("7", None), ("10", "b"), ("11", "c")]
    assert sorted((str(r["id"]), r["text"]) for r in ingest.first_rows(spark, out, "id").collect()) == sorted(want)
    # the same batch again changes nothing
    ingest.commit_batch(spark.createDataFrame([(5, "a", "x", t)], SCHEMA), 0, out, "text", "id")
    assert len(spark.read.parquet(f"{out}/commits").collect()) == 4
