import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import text_of, words

from sievework.llm import substring_dedup
from sievework.llm import text_arrays as ta
from sievework.llm.fm_index import FMIndex


def brute(rows, window):
    w = [(i, words(t)) for i, t, *_ in rows]
    seen = Counter(tuple(x[k : k + window]) for _, x in w for k in range(len(x) - window + 1))
    out = []
    for i, x in w:
        gone = [False] * len(x)
        for k in range(len(x) - window + 1):
            if seen[tuple(x[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(a for a, g in zip(x, gone, strict=True) if not g)
        out.append((i, len(x), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [substring_dedup.SHARD_PASSAGES, 2, 0])
def test_against_brute_force(docs, rows, limit):
    got = sorted((tuple(r) for r in substring_dedup.dedup(docs, shard_passages=limit).collect()), key=str)
    assert got == brute(rows, 35)


def test_short_windows(docs, rows):
    got = sorted((tuple(r) for r in substring_dedup.dedup(docs, window=12, gram=5).collect()), key=str)
    assert got == brute(rows, 12)


def test_text_is_cut(docs, rows):
    got = {r["doc_id"]: r for r in substring_dedup.without_repeats(docs).collect()}
    for i, n, gone, sha in brute(rows, 35):
        if gone == n and n:
            assert i not in got
        elif gone:
            assert hashlib.sha256(got[i]["text"].encode()).hexdigest() == sha and got[i]["n_chars"] == len(got[i]["text"])
        else:
            assert got[i]["text"] == next(t for k, t, *_ in rows if k == i)


def test_empty_and_odd_tables(empty, odd):
    assert substring_dedup.dedup(empty).count() == 0 and substring_dedup.without_repeats(empty).count() == 0
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.dedup(odd).collect()), key=str)
    assert got == sorted([(None, 60, 60), (1, 60, 60), (1, 60, 60), (2, 61, 60), (2, 3, 0), (3, 0, 0)], key=str)


def test_matching_statistics():
    rng = np.random.default_rng(0)
    for trial in range(30):
        seqs = [rng.integers(1, 4 + trial % 3, rng.integers(1, 30)) for _ in range(rng.integers(1, 8))]
        weights = rng.integers(1, 3, len(seqs))
        got = FMIndex(seqs, weights, 32).matching(seqs)
        count = Counter()
        for s, k in zip(seqs, weights, strict=True):
            for a in range(len(s)):
                for b in range(a + 1, len(s) + 1):
                    count[tuple(s[a:b])] += int(k)
        for s, own in zip(seqs, got, strict=True):
            for a in range(len(s)):
                assert own[a] == max([b - a for b in range(a + 1, len(s) + 1) if count[tuple(s[a:b])] >= 2], default=0)


def test_null_ids_count_and_lose_words(spark):
    rng = random.Random(2)
    passage = text_of(rng, 60, False)
    rows = [(None, text_of(rng, 30) + passage + text_of(rng, 9)), (7, passage + text_of(rng, 44)), (None, text_of(rng, 12) + passage), (None, passage), (None, passage), (8, passage + " x"), (8, text_of(rng, 70)), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 35)
    assert sorted((tuple(r) for r in substring_dedup.dedup(df).collect()), key=str) == want
    assert sum(gone > 0 for _, _, gone, _ in want) == 6
    kept = sorted(hashlib.sha256(" ".join(words(r["text"])).encode()).hexdigest() for r in substring_dedup.without_repeats(df).collect())
    # rows that lose all their words go
    assert kept == sorted(sha for _, n, gone, sha in want if not n or gone < n)


def test_anchors_do_not_depend_on_the_place_in_the_text():
    rng = random.Random(3)
    text = text_of(rng, 90_000, False)
    w = ta.split(pa.array([text, " ".join(words(text)[70_000:])]))
    doc, anchor, begin, count, at = substring_dedup.anchors_of(w, 35, 16)
    ends = np.searchsorted(doc, 1)
    late = begin[:ends] > 70_000
    assert late.sum() > 500
    assert set(zip(anchor[:ends][late], begin[:ends][late] + at[:ends][late])) <= set(zip(anchor[ends:], begin[ends:] + at[ends:] + 70_000))


def test_ties_of_anchors_go_to_the_last():
    w = ta.split(pa.array(["a b " * 30]))
    _, _, begin, count, at = substring_dedup.anchors_of(w, 35, 16)
    assert (count == 1).all() or (begin[1:] + at[1:] > begin[:-1] + at[:-1]).all()
    assert count.sum() == 60 - 34


def test_a_line_that_many_texts_share(spark):
    rng = random.Random(4)
    line = text_of(rng, 22, False)
    rows = [(i, text_of(rng, 40, False) + line + text_of(rng, 40, False)) for i in range(120)]
    rows += [(200 + i, text_of(rng, 3, False) + " ".join(words(rows[i][1])[8:90])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in substring_dedup.dedup(df, shard_passages=20).collect()), key=str) == brute(rows, 35)


def test_arrow_gives_back_its_memory_when_a_task_ends(monkeypatch):
    from types import SimpleNamespace

    from sievework.llm import common

    given = []
    pool = SimpleNamespace(release_unused=lambda: given.append(True))
    monkeypatch.setattr(common, "pa", SimpleNamespace(default_memory_pool=lambda: pool))
    batches = common.released(lambda rows: (2 * r for r in rows))(iter([1, 2]))
    assert next(batches) == 2 and next(batches) == 4 and not given
    assert next(batches, None) is None and given == [True]
