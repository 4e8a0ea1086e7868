import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import words
from pyspark.sql import functions as F

from sievework.llm import language_id, lm_scoring
from sievework.llm import text_arrays as ta
from sievework.llm.common import table

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    got = language_id.identify(docs, keep=["doc_id", "held_out", "lang", "text"]).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    test = [r for r in got if r["held_out"] and len(r["text"]) > 60]
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.97 * len(test) and len(test) > 40
    assert all(0 <= r["score"] <= 1 for r in got)


def grams(text):
    """Buckets of a text's n-grams, one after the other in plain integers."""
    line = re.sub(r" +", " ", "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
    code = [ord(c) for c in line]
    for n in language_id.ORDERS:
        for k in range(len(code) - n + 1):
            h = n
            for c in code[k : k + n]:
                h = (h * 0x9E3779B97F4A7C15 + c) % 2**64
            h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2**64
            yield h >> 48


def test_naive_bayes_against_brute_force(docs, rows):
    short = [r for r in rows if r[1] is not None and len(r[1]) < 3000]
    counts, texts = {"de": Counter(), "en": Counter()}, Counter()
    for _, t, lang, *_ in short:
        if lang:
            counts[lang].update(grams(t))
            texts[lang] += 1
    frame = docs.where("text is not null and n_chars < 3000")
    langs, table = language_id.train(frame)
    assert langs == ["de", "en"]
    got = {r["doc_id"]: r for r in language_id.predict(frame, (langs, table), keep=["doc_id"]).collect()}
    a = language_id.SMOOTHING
    for i, t, *_ in short:
        if not any(c.isalpha() for c in t):
            continue
        mine = Counter(grams(t))
        sums = [np.log(texts[k] / sum(texts.values())) + sum(n * np.log((counts[k][x] + a) / (counts[k].total() + a * language_id.BUCKETS)) for x, n in mine.items()) for k in langs]
        best = int(np.argmax(sums))
        assert got[i]["lang_pred"] == langs[best] or abs(sums[0] - sums[1]) < 1e-2
        assert abs(got[i]["score"] - 1 / sum(np.exp(np.array(sums) - max(sums)))) < 1e-2


def test_language_of_awkward_texts(docs, empty, odd, rows):
    got = {r["doc_id"]: r for r in language_id.identify(docs, keep=["doc_id", "text"]).collect()}
    for i, t, *_ in rows:
        assert (got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
        assert got[i]["lang_pred"] in ("und", "de", "en")
    assert language_id.identify(empty, keep=["doc_id"]).count() == 0
    assert language_id.identify(odd, keep=["doc_id"]).count() == 6
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(none, keep=["doc_id"]).collect()} == {"und"}
    assert language_id.accepted(docs).columns == docs.columns


def test_labels_and_ids_do_not_move_a_prediction(docs):
    model = language_id.train(docs)
    a = language_id.predict(docs, model, keep=["text"]).distinct()
    b = language_id.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("q")), model, keep=["text"]).distinct()
    assert a.exceptAll(b).count() == 0


def test_the_network_learns_from_both_sides(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = lm_scoring.train(docs.where("doc_id % 5 <> 0"))
    rng = random.Random(0)
    texts = [r["text"] for r in docs.where("doc_id % 5 = 0 and n_chars > 500").limit(60).collect()]
    mixed = []
    for t in texts:
        w = t.split()
        rng.shuffle(w)
        mixed.append(" ".join(w))
    df = spark.createDataFrame([(i, k, t) for k, ts in enumerate((texts, mixed)) for i, t in enumerate(ts)], "i int, shuffled int, text string")
    got = {(r["i"], r["shuffled"]): r["perplexity"] for r in lm_scoring.score(df, model, ["i", "shuffled"]).collect()}
    assert np.mean([got[i, 0] for i in range(len(texts))]) < lm_scoring.CODES * 0.8
    fresh = {r["i"]: r["perplexity"] for r in lm_scoring.score(df.where("shuffled = 0"), (model[0], lm_scoring.fresh()), ["i"]).collect()}
    assert sum(got[i, 0] < fresh[i] for i in range(len(texts))) >= 0.9 * len(texts)


def test_every_document_is_trained_on_once(docs, rows):
    for rounds in (1, 2, 3):
        turns = [[r["doc_id"] for r in lm_scoring.dealt(docs, t, rounds).collect()] for t in range(rounds)]
        assert sorted(sum(turns, [])) == sorted(r[0] for r in rows)
        assert all(len(t) > len(rows) / rounds / 3 for t in turns)


def test_scores_do_not_depend_on_partitions(docs, spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_WORDS", 3000)
    got = []
    for n, rows, shuffles in ((1, 256, "3"), (9, 7, "11")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        monkeypatch.setattr(lm_scoring, "small_batches", lambda s, rows=rows: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)))
        frame = docs.orderBy(F.rand(n)).repartition(n)
        model = lm_scoring.train(frame)
        got.append((model, {r["doc_id"]: tuple(r) for r in lm_scoring.score(frame, model, ["doc_id"], inside=True).collect()}))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    (a, one), (b, other) = got
    # the network to the bit, scores up to the rounding of single precision
    assert all(np.array_equal(a[1][k], b[1][k]) for k in a[1]) and one.keys() == other.keys()
    flat = lambda x: np.array([[np.nan if v is None else v for v in x[i]] for i in sorted(x)], float)
    assert np.allclose(flat(one), flat(other), rtol=1e-6, atol=0, equal_nan=True)
    # several parts in one partition are trained as if each had its own
    own = lm_scoring.train_round(docs, a[0], lm_scoring.fresh(), 5)
    parted = lm_scoring.parted
    assert parted(docs, 5).count() == docs.count() and parted(docs, 5).select("part").distinct().count() == 5
    monkeypatch.setattr(lm_scoring, "parted", lambda d, n: parted(d, n).coalesce(1))
    together = lm_scoring.train_round(docs, a[0], lm_scoring.fresh(), 5)
    assert all(np.array_equal(own[k], together[k]) for k in own)


def test_real_order_scores_better_and_rare_words_differ(spark):
    rng = random.Random(3)
    after = {i: rng.sample(range(60), 2) for i in range(60)}

    def text(n):
        at, out = rng.randrange(60), []
        for _ in range(n):
            at = rng.choice(after[at])
            out.append(f"w{at}")
        return " ".join(out)

    docs = spark.createDataFrame([(i, text(400)) for i in range(400)], "doc_id long, text string")
    # more words than have codes of their own: word i stands i % 5 + 2 times
    many = [(1000 + k, " ".join(f"r{i}" for i in range(6000) if i % 5 + 2 > k)) for k in range(6)]
    docs = docs.union(spark.createDataFrame(many, docs.schema)).repartition(2)
    model = lm_scoring.train(docs)
    real = [text(100) for _ in range(30)]
    mixed = [" ".join(rng.sample(t.split(), 100)) for t in real]
    # words of one code; the text holds nothing else, so their contexts are equal
    names = [f"r{i}" for i in range(6000)] + [f"unseen{i}" for i in range(3000)]
    w = ta.split(pa.array(names))
    code = model[0](ta.word_hashes(w))
    one = int(np.bincount(code[(code >= lm_scoring.FREQUENT)]).argmax())
    alone = [names[i] for i in np.flatnonzero(code == one)]
    df = spark.createDataFrame(list(enumerate(real + mixed + alone)), "i int, text string")
    got = {r["i"]: r["log_likelihood"] for r in lm_scoring.score(df, model, ["i"]).collect()}
    assert sum(got[i] > got[30 + i] for i in range(30)) >= 27
    each = {x: got[60 + k] for k, x in enumerate(alone)}
    seen = {x: int(x[1:]) % 5 + 2 for x in each if x[0] == "r"}
    assert len(set(seen.values())) > 1 and any(x[0] == "u" for x in each)
    low = min(seen, key=seen.get)
    assert all(abs(each[x] - each[low] - np.log(n / seen[low])) < 1e-5 for x, n in seen.items())
    # unseen words share one occurrence, as many of them as seen ones
    types = int((code[:6000] == one).sum())
    assert all(abs(each[x] - each[low] + np.log(seen[low]) + np.log(types + 1)) < 1e-5 for x in each if x[0] == "u")


def test_own_occurrences_do_not_count_inside_the_corpus(spark):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(40)]
    own = lambda k: " ".join(x for i in range(100) for x in (rng.choice(common), f"own{k}x{i}"))
    texts = [own(k) for k in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:10])] + [(200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # more frequent words than have codes of their own
    docs = docs.union(spark.createDataFrame([(300 + k, " ".join(f"f{i}" for i in range(3200))) for k in range(3)], docs.schema))
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, lm_scoring.train(docs), ["doc_id"], inside=True).collect()}
    twice, once = [got[i]["mean_log_likelihood"] for i in (*range(10), *range(100, 110))], [got[i]["mean_log_likelihood"] for i in range(10, 60)]
    assert min(twice) > max(once)
    assert all(got[i]["seen_elsewhere"] == 1 for i in range(10)) and all(got[i]["seen_elsewhere"] == 0 for i in range(10, 60))
    assert got[200]["mean_log_likelihood"] is None and got[200]["seen_elsewhere"] is None


def test_scores_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5)) % 9000}" for _ in range(rng.randrange(1, 300))) for _ in range(200)] + [None, "", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    coder, params = lm_scoring.train(docs)
    counts = Counter(x for t in texts for x in words(t))
    code = dict(zip(counts, coder(ta.word_hashes(ta.split(pa.array(list(counts))))), strict=True))
    total, types = Counter(), Counter()
    for x, n in counts.items():
        total[code[x]] += n
        types[code[x]] += 1
    for inside in (False, True):
        got = {r["doc_id"]: r for r in lm_scoring.score(docs, (coder, params), ["doc_id"], inside=inside).collect()}
        for i, t in enumerate(texts):
            w, want = words(t), 0.0
            here = Counter(w)
            for k, x in enumerate(w):
                ctx = [code[w[j]] if 0 <= j < len(w) else lm_scoring.CODES for j in (k - 2, k - 1, k + 1, k + 2)]
                want += lm_scoring.log_probability(params, np.array(ctx)[:, None], np.array([code[x]]))[0]
                if code[x] >= lm_scoring.FREQUENT:
                    n = counts[x] - (here[x] if inside else 0)
                    want += np.log(n if n else 1 / (types[code[x]] + 1)) - np.log(total[code[x]] + 1)
            assert abs(got[i]["log_likelihood"] - want) < 1e-3 * (len(w) + 1)


def test_steps_lower_the_loss_and_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    seq = np.tile(rng.integers(0, lm_scoring.CODES, 50), 40)
    ctx = lm_scoring.contexts(seq, np.zeros(len(seq), np.int64))
    p = lm_scoring.fresh()
    before = lm_scoring.log_probability(p, ctx, seq).mean()
    for _ in range(3):
        for i in range(0, len(seq), 256):
            lm_scoring.train_step(p, ctx[:, i : i + 256], seq[i : i + 256])
    assert lm_scoring.log_probability(p, ctx, seq).mean() > before + 0.3
    every = np.arange(lm_scoring.CODES)
    total = np.exp(lm_scoring.log_probability(p, np.repeat(ctx[:, 5:6], len(every), axis=1), every)).sum()
    assert abs(total - 1) < 1e-3


def test_context_ends_with_the_document():
    c = lm_scoring.contexts(np.array([1, 2, 3, 9]), np.array([0, 0, 0, 1]))
    end = lm_scoring.CODES
    assert c.T.tolist() == [[end, end, 2, 3], [end, 1, 3, end], [1, 2, end, end], [end] * 4]


def test_gradients():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in lm_scoring.fresh().items()}
    ctx, code = rng.integers(0, 4097, (4, 3)), rng.integers(0, 4096, 3)
    loss = lambda q: -lm_scoring.log_probability(q, ctx, code).mean()
    q = {k: v.copy() for k, v in p.items()}
    lm_scoring.train_step(q, ctx, code, 1.0)
    for k in ("h", "u0", "u1", "u2", "d1", "d2", "b2", "hb"):
        at = tuple(int(x) for x in np.argwhere(np.abs(q[k] - p[k]) > 1e-9)[0])
        up = {n: v.copy() for n, v in p.items()}
        up[k][at] += 1e-5
        assert abs((loss(up) - loss(p)) / 1e-5 - (p[k] - q[k])[at]) < 1e-3


def test_scores_of_awkward_texts(docs, empty, odd, rows):
    model = lm_scoring.train(docs, rounds=1)
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, model, ["doc_id"]).collect()}
    for i, t, *_ in rows:
        assert got[i]["n_tokens"] == len(words(t)) and got[i]["log_likelihood"] <= 0
    assert got[300]["n_tokens"] == 0 and got[300]["perplexity"] is None and got[301]["log_likelihood"] == 0
    assert got[303]["log_likelihood"] == got[304]["log_likelihood"]
    assert lm_scoring.score(empty, lm_scoring.train(empty), ["doc_id"]).count() == 0
    assert lm_scoring.score(odd, model, ["doc_id"]).count() == 6
