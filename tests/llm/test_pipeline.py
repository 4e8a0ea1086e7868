import re
from collections import Counter, defaultdict

import public_tokenizers
from cases import words
from pyspark.sql import functions as F
from test_jaccard_join import brute as components_of

import corpus_pipeline
from sievework.llm import mixing


def test_stages_against_brute_force(spark, docs, rows, tmp_path):
    path = f"file://{tmp_path}"
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    d, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, d, path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == d.columns
        out.write.parquet(f"{path}/{name}")
        d = spark.read.parquet(f"{path}/{name}")
        seen.append(d.collect())
    told, single, cut, mixed, packed = seen
    letters = {i for i, t, *_ in rows if re.search(r"[^\W\d_]", t or "")}
    assert {r["doc_id"] for r in told} == letters
    want = components_of([(r["doc_id"], r["text"]) for r in told], 5, 8, 10)
    assert {r["doc_id"] for r in single} == {i for i, (_, c) in want.items() if i == c}
    # passages of 35 words that stand twice are gone
    count = Counter(tuple(w[k : k + 35]) for w in (words(r["text"]) for r in single) for k in range(len(w) - 34))
    for r in single:
        w, gone = words(r["text"]), set()
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone |= set(range(k, k + 35))
        kept = [x for k, x in enumerate(w) if k not in gone]
        assert [words(c["text"]) for c in cut if c["doc_id"] == r["doc_id"]] == ([kept] if kept else [])
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix(spark.createDataFrame(cut, d.sparkSession.read.parquet(f"{path}/mixing").schema), keep=["doc_id"]).collect()}
    n = defaultdict(int)
    for r in mixed:
        n[r["doc_id"]] += len(words(r["text"]))
    assert {i: k for i, k in plan.items() if k} == dict(n)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r["length"] for r in packed) == sum(len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed)


def test_run_and_an_empty_table(spark, docs, tmp_path):
    path = f"file://{tmp_path}"
    docs.select("doc_id", "text", "lang", "source", "n_chars").where(F.col("doc_id") < 30).write.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.run(spark, path).count() > 0
    docs.select("doc_id", "text", "lang", "source", "n_chars").where("false").write.parquet(f"{path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{path}/none").count() == 0
