import hashlib
import re
from collections import defaultdict

import pytest
from cases import SCHEMA

from sievework.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s : s + 10])].add(i)
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture(scope="module")
def items(rows):
    text = {i: t for i, t, *_ in rows}
    w = words(text[5])
    data = [(1, " ".join(w[3:40])), (20, " ".join(w[10:22]).upper()), (3, " ".join(w[:4])), (4, None), (5, " -- "), (6, ""), (None, " ".join(w[30:45])), (7, "lo rem ip sum lo rem ip sum lo rem ip sum"), (7, "lo rem ip sum lo rem ip sum lo rem ip sum")]
    return [*data, (8, "é ü 12"), (9, "É ü 12"), (10, "nowhere " * 12), (11, " ".join(["ab"] * 30)), (12, " ".join(words(text[100])[20:70])), (13, "gpl")]


def run(spark, docs, items):
    return decontamination.verdicts(docs, spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])


def test_verdicts_against_brute_force(spark, docs, rows, items):
    got = sorted(tuple(r) for r in run(spark, docs, items).collect())
    assert got == sorted(brute([(r[0], r[1]) for r in rows], items))
    assert sum(r[5] for r in got) > 20


def test_the_main_path_has_no_python(spark, docs, items):
    p = run(spark, docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "Arrow" not in p


def test_shuffled_tables_give_the_same(spark, docs, items, rows, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    got = sorted(tuple(r) for r in run(spark, docs.repartition(3), items).collect())
    assert got == sorted(brute([(r[0], r[1]) for r in rows], items))


def test_odd_tables(spark, docs, empty, odd, items):
    assert run(spark, empty, items).count() == 0
    clean = run(spark, docs, []).collect()
    assert len(clean) == docs.count() and not any(r["contaminated"] or r["n_items"] for r in clean)
    some = [(r["doc_id"], r["text"]) for r in odd.collect()]
    more = [*items, (50, some[0][1])]
    assert sorted(map(str, map(tuple, run(spark, odd, more).collect()))) == sorted(map(str, brute(some, more)))
    clash = decontamination.verdicts(odd.withColumnRenamed("n", "n_hit"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id", "n_hit", "words"])
    assert clash.columns == ["doc_id", "words", *decontamination.RESULTS] and clash.count() == odd.count()


def test_phrases_and_proximity_against_brute_force(spark, docs, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontamination.build(docs, bench)
    windows = {r["w"]: tuple(r["win"]) for r in index.windows.collect()}
    keys = {bytes.fromhex(hashlib.md5(t.encode()).hexdigest()): words(t) for _, t, *_ in rows if t is not None}
    hits = {bytes(r["h"]): [tuple(x) for x in r["hits"]] for r in decontamination.phrases(docs, index).collect()}
    want = {h: sorted((s, k, len(v)) for k, v in windows.items() for s in range(len(w) - len(v) + 1) if tuple(w[s : s + len(v)]) == v) for h, w in keys.items()}
    assert hits == {h: x for h, x in want.items() if x}
    near = {bytes(r["h"]): set(r["near"]) for r in decontamination.proximity(docs, index, span=14).collect()}

    def close(w, v):
        at = [k for k, x in enumerate(w) if x in v]
        return any(set(w[k : k + 14]) >= set(v) for k in at)

    want = {h: {k for k, v in windows.items() if close(w, v)} for h, w in keys.items()}
    assert near == {h: x for h, x in want.items() if x}
    assert any(len(near[h]) > len({k for _, k, _ in hits.get(h, [])}) for h in near)
    assert SCHEMA.startswith("doc_id")
