import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import centroid_clustering, vector_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, code string, cluster string"


def brute(x, books):
    d = ((x[:, None, :] - books[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


def lloyd(x, c, rounds):
    c = c.copy()
    for _ in range(rounds):
        a, _ = brute(x, c)
        for j in range(len(c)):
            if (a == j).any():
                c[j] = x[a == j].sum(0) // (a == j).sum()
    return c


def table(spark, n=700, width=64, seed=3):
    """Vectors in clumps, with copies, ties, nulls and values that aren't finite."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(9, width))
    x = (middle[rng.integers(0, 9, n)] + 0.2 * rng.normal(size=(n, width))).astype(np.float32)
    x[40:70] = x[40:41]
    x[200:230, : width // 2] = x[200:201, : width // 2]
    rows = [(i * 3, v.tolist(), [None, 1, 2][i % 3], "c", "c") for i, v in enumerate(x)]
    odd = [(1, None, 1), (4, [None] * width, 1), (7, [float("nan")] * width, 2), (10, [float("inf")] + [0.0] * (width - 1), None), (13, [1.0] * (width - 1), 1), (16, [], 2)]
    rows += [(i, v, k, "c", "c") for i, v, k in odd]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(6), {r[0]: r for r in rows}


@pytest.mark.parametrize("scale", [1, 7, 2000, 2**26])
def test_screening_keeps_the_nearest_entry(scale):
    rng = np.random.default_rng(scale)
    books = rng.integers(-scale, scale + 1, (200, 16))
    books[50:60] = books[3]
    x = np.concatenate([rng.integers(-scale, scale + 1, (2500, 16)), books[rng.integers(0, 200, 300)], (books[:100] + books[100:]) // 2])
    book = vector_codes.Codebook(books)
    index, distance = book.nearest(x)
    want, least = brute(x, books)
    assert (index == want).all() and (distance == least).all()
    # few entries are evaluated again, unless they are truly close
    assert scale < 2000 or book.screen(x[:2500]).sum(1).mean() < 1.5


def test_codes_against_brute_force(spark):
    df, rows = table(spark)
    got = {r["vec_id"]: r for r in vector_codes.compress(df, ["vec_id", "code"]).collect()}
    good = sorted(i for i, r in rows.items() if r[1] is not None and len(r[1]) == 64 and np.isfinite(np.array(r[1], float)).all())
    x = np.floor(np.array([rows[i][1] for i in good], np.float32).astype(float) * 1024).astype(np.int64)
    books = [lloyd(x[:, p * 16 : p * 16 + 16], x[:256, p * 16 : p * 16 + 16], 4) for p in range(4)]
    found = [brute(x[:, p * 16 : p * 16 + 16], books[p]) for p in range(4)]
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    errors = {i: int(sum(e[k] for _, e in found)) for k, i in enumerate(good)}
    # vectors of another width are kept without a code
    assert set(got) == {*good, 13, 16} and got[13]["code"] is None and got[16]["error"] is None
    for k, i in enumerate(good):
        label = sum(e for j, e in errors.items() if rows[j][2] == rows[i][2])
        assert (got[i]["code"], got[i]["error"], got[i]["label_error"], got[i]["codebooks_sha256"]) == ("".join(f"{a[k]:02x}" for a, _ in found), errors[i], label, digest)
    out = vector_codes.decode(vector_codes.encode(df, np.stack(books), ["vec_id"]), np.stack(books)).collect()
    for r in out:
        if r["code"] is not None:
            y = np.array(r["approximation"]) * 1024
            assert ((x[good.index(r["vec_id"])] - y) ** 2).sum() == errors[r["vec_id"]]


def test_codes_of_odd_tables(spark):
    df, _ = table(spark, 5)
    assert vector_codes.compress(df.where("false"), ["vec_id"]).count() == 0
    few = vector_codes.compress(df.where("size(embedding) = 64"), ["vec_id"]).collect()
    assert len(few) == 5 and {r["error"] for r in few} == {0}
    uneven = spark.createDataFrame([(1, [1.0, 2.0, 3.0], None), (None, [1.0] * 4, 1), (1, [1.0, 2.0, 3.0], None)], "vec_id long, embedding array<double>, label int")
    assert [(r["code"], r["label_error"]) for r in vector_codes.compress(uneven, ["vec_id"]).collect()] == [(None, None)] * 3
    again = uneven.where("size(embedding) = 4").union(uneven.where("size(embedding) = 4"))
    assert {r["code"] for r in vector_codes.compress(again, ["vec_id"]).collect()} == {"00000000"}
    with pytest.raises(Exception, match="don't fit 64 bits"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 4, 1)], "vec_id long, embedding array<double>, label int"), ["vec_id"]).count()
    assert vectors.component_limit(64) >= 1 << 26


def test_clusters_against_brute_force(spark):
    df, rows = table(spark)
    got = {r["vec_id"]: r for r in centroid_clustering.cluster(df, ["vec_id", "cluster"]).collect()}
    good = sorted(i for i, r in rows.items() if r[1] is not None and len(r[1]) == 64 and np.isfinite(np.array(r[1], float)).all())
    x = np.floor(np.array([rows[i][1] for i in good], np.float32).astype(float) * 64).astype(np.int64)
    first = sorted(range(len(good)), key=lambda k: hashlib.sha256(f"1:{good[k]}".encode()).hexdigest())[:16]
    c = lloyd(x, x[first], 3)
    a, d = brute(x, c)
    assert set(got) == set(good)
    for k, i in enumerate(good):
        want = (a[k], d[k], d[a == a[k]].sum(), d.sum(), hashlib.sha256(",".join(map(str, c[a[k]].tolist())).encode()).hexdigest())
        assert tuple(got[i][n] for n in centroid_clustering.RESULTS) == want


@pytest.mark.parametrize("spread", [0, 1, 3, 400])
def test_bounds_give_the_assignment_of_a_full_scan(spread):
    rng = np.random.default_rng(spread)
    c = rng.integers(-spread - 1, spread + 2, (16, 8)) + (np.arange(16) % 5)[:, None] * 3 * spread
    x = c[rng.integers(0, 16, 600)] + rng.integers(-spread - 1, spread + 2, (600, 8))
    groups = centroid_clustering.group_centroids(c)
    assert len(groups) == 16
    own, upper, lower, scanned = centroid_clustering.first_state(x, c, groups)
    assert scanned == 600 * 16
    for _ in range(6):
        assert (own == brute(x, c)[0]).all()
        new = lloyd(x, c, 1)
        moved = centroid_clustering.above(((new - c) ** 2).sum(1))
        c = new
        own, upper, lower, scanned = centroid_clustering.next_state(x, c, groups, moved, own, upper, lower)
    # where clumps stand apart and have settled, most centroids aren't looked at
    assert spread < 400 or scanned < 600 * 8


def test_clusters_of_odd_tables(spark):
    df, _ = table(spark, 5)
    assert centroid_clustering.cluster(df.where("false"), ["vec_id"]).count() == 0
    few = centroid_clustering.cluster(df, ["vec_id"]).collect()
    assert len(few) == 5 and {r["inertia"] for r in few} == {0} and len({r["cluster"] for r in few}) == 5
    copies = df.where("vec_id = 0").drop("cluster").crossJoin(spark.range(40)).withColumn("vec_id", F.when(F.col("id") > 3, F.col("id")))
    got = centroid_clustering.cluster(copies, ["vec_id"]).collect()
    assert len(got) == 40 and {r["cluster"] for r in got} == {0}
    shuffled = centroid_clustering.cluster(df.repartition(3), ["vec_id"]).collect()
    assert sorted(map(tuple, shuffled)) == sorted(map(tuple, few))
