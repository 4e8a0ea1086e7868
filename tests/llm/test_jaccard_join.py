import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import words

from sievework.llm import jaccard_join
from sievework.llm import text_arrays as ta

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n, num, den):
    sets = {}
    for i, t, *_ in rows:
        w = words((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    for a, b in {p for m in lists.values() for p in itertools.combinations(sorted(m), 2)}:
        o = len(sets[a] & sets[b])
        if den * o >= num * (len(sets[a]) + len(sets[b]) - o):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 8, 10), (1, 5, 10)])
def test_against_brute_force(docs, rows, n, num, den):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs, n, (num, den)).collect()}
    assert got == brute(rows, n, num, den)


def test_order_of_the_index_does_not_matter(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda *a, **k: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs, 3, (9, 10)).collect()}
    assert got == brute(rows, 3, 90, 100)


def test_one_of_each_group_stays(docs, rows):
    out = jaccard_join.one_of_each(docs, 5, (8, 10))
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, (_, c) in brute(rows, 5, 8, 10).items() if i == c)


def test_empty_and_odd_tables(empty, odd):
    assert jaccard_join.join(empty).count() == 0 and jaccard_join.one_of_each(empty).count() == 0
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_join.join(odd, 3, (9, 10)).collect()), key=str)
    assert got == sorted([(None, None), (1, 1), (1, 1), (2, 1), (2, 1), (3, 3)], key=str)
    # of id 2 the text that is nobody's copy stays
    assert sorted((str(r["doc_id"]), r["text"]) for r in jaccard_join.one_of_each(odd, 3, (9, 10)).collect() if r["doc_id"] == 2) == [("2", "other words here")]
    assert sorted(str(r["doc_id"]) for r in jaccard_join.one_of_each(odd, 3, (9, 10)).collect()) == ["1", "2", "3", "None"]


def test_rows_of_one_id_are_held_against_others_one_by_one(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    data = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, c), (5, ""), (5, None), (None, a), (2, c)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = sorted(map(tuple, jaccard_join.one_of_each(df).collect()), key=str)
    assert out == sorted([(1, a), (2, b), (2, c), (5, ""), (5, None), (None, a)], key=str)


def test_thresholds_below_a_half_are_refused(docs):
    with pytest.raises(ValueError, match="threshold"):
        jaccard_join.join(docs, 3, (49, 100))


def test_words_are_split_and_hashed_alike():
    texts = ["A b\tc", None, "", "  x  ", "b A b c", "c" * 5000 + " b"]
    w = ta.split(pa.array(texts), lower=True)
    h = ta.word_hashes(w)
    found = [bytes(w.data[a:b]).decode() for a, b in zip(w.starts, w.ends, strict=True)]
    assert found == ["a", "b", "c", "x", "b", "a b", "c", "c" * 5000, "b"]
    assert w.counts.tolist() == [3, 0, 0, 1, 3, 2]
    assert len({(f, int(x)) for f, x in zip(found, h, strict=True)}) == len(set(found)) == len(set(h.tolist()))
    whole = ta.word_hashes(ta.split(pa.array(texts).slice(4, 2), lower=True))
    assert whole.tolist() == h[4:].tolist()
