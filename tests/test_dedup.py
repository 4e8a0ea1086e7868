import random
from hashlib import md5

from pyspark.sql import functions as F

from sievework.functions.hashing import text_simhash
from sievework.operators import dedup
from sievework.operators.graph import components


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_bands_find_all_pairs(spark):
    rng = random.Random(1)
    hashes = [rng.getrandbits(64) for _ in range(60)]
    for h in list(hashes):
        x = h
        for b in rng.sample(range(64), rng.randint(0, 9)):
            x ^= 1 << b
        hashes.append(x)
    flips = [int(f"{h:064b}"[::-1], 2) for h in hashes]
    df = spark.createDataFrame([(i, "a", signed(h), signed(f)) for i, (h, f) in enumerate(zip(hashes, flips, strict=True))], "ord long, label string, hash long, flip long")
    classes = dedup.hash_classes(df, ["hash", "flip"], "label", "ord")
    d = lambda a, b: (a ^ b).bit_count()
    reps = {h: i for i, h in reversed(list(enumerate(hashes)))}
    want = {(i, j, d(a, b)) for a, i in reps.items() for b, j in reps.items() if i < j and d(a, b) <= 8}
    assert {(r["rep_a"], r["rep_b"], r["distance"]) for r in dedup.near_pairs(classes, "label", 8).collect()} == want
    want = {(i, j, min(d(a, b), d(flips[i], b))) for a, i in reps.items() for b, j in reps.items() if i < j and min(d(a, b), d(flips[i], b)) <= 8}
    assert {(r["rep_a"], r["rep_b"], r["distance"]) for r in dedup.near_pairs(classes, "label", 8, flipped="flip").collect()} == want


    got = {r["node"]: r["component"] for r in components(dedup.links(classes, "label", 4).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))).collect()}
    pairs = dedup.near_pairs(classes, "label", 4).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    assert got == {r["node"]: r["component"] for r in components(pairs).collect()} and len(got) > 20


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_choice(spark):
    data = [(1, "c", 10, 5.0), (2, "c", 90, 1.0), (3, "c", 50, 9.0), (4, "c", 50, 4.0), (5, "d", None, 0.0), (6, "e", 3, 0.0), (7, "e", 3, 0.0)]
    df = spark.createDataFrame(data, "ord long, cluster_id string, area int, sharp double")
    got = {r["ord"]: r["role"] for r in dedup.choose(df, "cluster_id", "ord", "area", "sharp", cap=1).collect()}
    assert got == {1: "augmented", 2: "dropped", 3: "canonical", 4: "dropped", 5: "unique", 6: "canonical", 7: "augmented"}


def test_simhash_of_short_and_null_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, "a b c"), (5, " A  b\tC ")], "k long, text string")
    got = {r["k"]: r["hash"] for r in text_simhash(df, "k", "text").collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[4] == got[5] and got[1] == got[2]
    # a text of fewer words is one gram
    assert got[3] == signed(int.from_bytes(md5(b"a b").digest()[:8])) and got[4] == signed(int.from_bytes(md5(b"a b c").digest()[:8]))


def test_wide_slices_with_near_values_lose_no_pair(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    hashes = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 11))) for b in base for _ in range(6)]
    signed = [h - (1 << 64) if h >> 63 else h for h in dict.fromkeys(hashes)]
    rows = [(i, "a" if i % 5 else None, h, 1) for i, h in enumerate(signed)]
    classes = spark.createDataFrame(rows, "rep long, label string, hash long, members long")
    apart = {(i, j): bin((h ^ g) & (1 << 64) - 1).count("1") for i, k, h, _ in rows for j, m, g, _ in rows if i < j and k == m}
    for most in (4, 8):
        want = {p: d for p, d in apart.items() if d <= most}
        for n, r in dedup.CUTS:
            if n * (r + 1) > most and r < 3:
                got = {(x["rep_a"], x["rep_b"]): x["distance"] for x in dedup.near_pairs(classes, "label", most, cut_by=(n, r)).collect()}
                assert got == want

    def joined(pairs):
        root = {i: i for i, *_ in rows}
        for _ in rows:
            for i, j in pairs:
                root[i] = root[j] = min(root[i], root[j])
        return root

    tight = [p for p, d in apart.items() if d <= 4]
    for way in ((5, 0), (3, 1)):
        found = [(x["rep_a"], x["rep_b"]) for x in dedup.links(classes, "label", 4, cut_by=way).collect()]
        assert set(found) <= set(tight) and joined(found) == joined(tight)
    # few rows are cut narrowly, very many widely
    assert dedup.cut_for(4, 1000) == (5, 0) and dedup.cut_for(8, 1000)[1] == 0
    assert dedup.cut_for(4, 10**9)[1] > 0 and dedup.cut_for(8, 10**9)[1] > 0 and dedup.cut_for(20, 10) == (21, 0)
    got = {r["rep"]: r["links"] for r in dedup.degrees(classes.where("rep < 3"), spark.createDataFrame([(0, 1)], "rep_a long, rep_b long")).collect()}
    assert got == {0: 1, 1: 1, 2: 0}


def test_exploded_lists_are_never_broadcast(spark, monkeypatch):
    # 66 lists a class, while Spark takes the size of the classes for theirs
    rng = random.Random(8)
    rows = [(i, "a", signed(rng.getrandbits(64)), 1) for i in range(3000)]
    classes = dedup.cut(spark.createDataFrame(rows, "rep long, label string, hash long, members long"), "classes")
    plans = {}

    def kept(df, tag, cut=dedup.cut):
        plans[tag] = df._jdf.queryExecution().executedPlan().toString()
        return cut(df, tag)

    monkeypatch.setattr(dedup, "cut", kept)
    more = dedup.links(classes, "label", 4, cut_by=(3, 1))
    assert "BuildLeft" not in plans["lists"] and "Generate" in plans["lists"]
    assert "SortMergeJoin" in more._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in dedup.near_pairs(classes, "label", 4, cut_by=(3, 1))._jdf.queryExecution().executedPlan().toString()
    # lists' heads and components are broadcast after a count only
    monkeypatch.setattr("sievework.operators.joins.BROADCAST_ROWS", -1, raising=False)
    dedup.links(classes, "label", 4, cut_by=(3, 1))
    assert "BroadcastExchange" not in plans["lists"] + plans["labelled"]


def test_clusters_of_small_files_are_joined_by_a_shuffle(spark):
    rows = dedup.cut(spark.range(3000).selectExpr("id as ord", "'a' as label", "id as hash", "id as size", "1.0 as sharp", "cast(id as string) as cluster_id"), "rows")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(dedup.choose(rows, "cluster_id", "ord", "size", "sharp"))
