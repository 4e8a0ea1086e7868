"""Centroid clustering with Yinyang bounds, in exact integers.

Centroids are put into groups once. A vector keeps an upper bound of the distance to its own
centroid and, for each group, a lower bound of the distance to the group's other centroids; both travel with it
in a table that each round writes anew. After the centroids have moved, bounds move by as much. A vector whose
least lower bound is above its upper bound keeps its cluster without a look (global filter);
else the upper bound is made exact and the test repeated, then only groups whose own bound isn't above it are
scanned (group filter), by exact squared distances in int64. Bounds are doubles rounded outwards, and a group is
skipped only if its bound is strictly above, so ties go to the smaller number as in a full scan.

Defined results: vectors of another number of components, null ones and those with null or
non-finite components are dropped. Fewer vectors than clusters make fewer centroids. Rows that
repeat an id count each; equal ids start in the order of their vectors, null ids last. Empty clusters keep their centroid
and have no rows. An empty table gives an empty result. A component above ``vectors.component_limit`` after scaling is
an error. Other columns pass if they are asked for; those named like results give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.common import cut, drop
from sievework.llm.vectors import finite, integers, summed, with_fields

WIDTH, CLUSTERS, ROUNDS, SCALE, GROUP_SIZE = 64, 16, 3, 64, 4
#: Relative room for the rounding of a few double operations.
ROOM = 2.0**-48
#: Numbers that one pass holds for distances in int64.
HELD = 1 << 22
RESULTS = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4.0 * x.shape[1] * float(most) ** 2 < 2**53:
        # all sums are integers that doubles hold
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)).astype(np.int64)
    step = max(1, HELD // max(1, c.size))
    return np.concatenate([((x[i : i + step, None] - c) ** 2).sum(2) for i in range(0, len(x), step)] or [np.zeros((0, len(c)), np.int64)])


def above(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + ROOM)


def below(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 - ROOM)


def group_centroids(c: np.ndarray, size: int = GROUP_SIZE, rounds: int = 5) -> np.ndarray:
    """A group for each centroid: a few rounds of plain clustering of the centroids, from the first and those farthest on."""
    n = -(-len(c) // size)
    seeds = [0]
    while len(seeds) < n:
        seeds.append(int(squared(c, c[seeds]).min(axis=1).argmax()))
    middle = c[seeds].astype(np.float64)
    for _ in range(rounds):
        group = ((c[:, None] - middle) ** 2).sum(2).argmin(1)
        middle = np.stack([c[group == g].mean(0) if (group == g).any() else middle[g] for g in range(n)])
    return group


def first_state(x: np.ndarray, c: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper bound, lower bound by group, distances evaluated) by a full scan."""
    d = squared(x, c)
    own = d.argmin(1)
    others = below(d)
    others[np.arange(len(x)), own] = np.inf
    lower = np.stack([others[:, groups == g].min(1, initial=np.inf) for g in range(groups.max() + 1)], axis=1)
    return own, above(d[np.arange(len(x)), own]), lower, d.size


def next_state(x: np.ndarray, c: np.ndarray, groups: np.ndarray, moved: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The state after centroids moved to ``c``, each by at most ``moved``."""
    n_groups = groups.max() + 1
    most = np.array([moved[groups == g].max(initial=0) for g in range(n_groups)])
    own, upper, evaluated = own.copy(), (upper + moved[own]) * (1 + ROOM), 0
    lower = lower - most - ROOM * (np.where(np.isfinite(lower), np.abs(lower), 0) + most)
    open_ = np.flatnonzero(lower.min(1) <= upper)
    # the exact distance to the own centroid, then both filters again
    mine = ((x[open_] - c[own[open_]]) ** 2).sum(1)
    evaluated += len(open_)
    upper[open_] = above(mine)
    scan = lower[open_] <= upper[open_, None]
    some = scan.any(1)
    open_, mine, scan = open_[some], mine[some], scan[some]
    before, best, at = own[open_], mine.copy(), own[open_].copy()
    seen = np.full((len(open_), len(c)), np.inf)
    for g in range(n_groups):
        members, rows = np.flatnonzero(groups == g), np.flatnonzero(scan[:, g])
        if not len(members) or not len(rows):
            continue
        d = squared(x[open_[rows]], c[members])
        evaluated += d.size
        seen[rows[:, None], members] = below(d)
        least = d.min(1)
        who = members[d.argmin(1)]
        better = (least < best[rows]) | ((least == best[rows]) & (who < at[rows]))
        best[rows[better]], at[rows[better]] = least[better], who[better]
    everyone = np.arange(len(open_))
    # the former centroid was seen exactly, whether its group was scanned or not
    left = at != before
    seen[everyone[left], before[left]] = below(mine[left])
    seen[everyone, at] = np.inf
    for g in range(n_groups):
        least = seen[:, groups == g].min(1, initial=np.inf)
        lower[open_, g] = np.where(scan[:, g], least, np.minimum(lower[open_, g], least))
    own[open_], upper[open_] = at, above(best)
    return own, upper, lower, evaluated


def first_centroids(vectors: DataFrame, key: str, column: str, clusters: int, width: int, scale: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``1:`` and the id."""
    rows = vectors.select(F.sha2(F.concat(F.lit("1:"), F.col(key).cast("string")), 256).alias("_h"), F.col(column).alias("_v"))
    rows = rows.where((F.size("_v") == width) & finite(F.col("_v"))).orderBy(F.col("_h").asc_nulls_last(), "_v").limit(clusters)
    found = [r["_v"] for r in rows.collect()]
    return np.floor(np.array(found, np.float64).reshape(-1, width) * scale).astype(np.int64)


def _step(rows: DataFrame, c: np.ndarray, groups: np.ndarray, moved: np.ndarray | None, width: int, scale: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, wide, x = integers(b.column("_v"), width, scale)
            at = pa.array(good[wide])
            if moved is None:
                own, upper, lower, n = first_state(x, c, groups)
            else:
                lower = b.column("_lower").flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                own, upper, lower, n = next_state(x, c, groups, moved, b.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64), b.column("_upper").to_numpy(zero_copy_only=False), lower)
            scanned = np.zeros(len(x), np.int64)
            scanned[:1] = n
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * lower.shape[1], pa.int32()), pa.array(lower.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("_row").take(at), b.column("_v").take(at), pa.array(own, pa.int32()), pa.array(upper), lists, pa.array(scanned)], ["_row", "_v", "cluster", "_upper", "_lower", "_scanned"])

    return rows.mapInArrow(make, with_fields(rows, ["_row", "_v"], "cluster int, _upper double, _lower array<double>, _scanned long"))


def fit(vectors: DataFrame, keep: list[str], key: str = "vec_id", column: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE) -> tuple[DataFrame | None, np.ndarray, list[int]]:
    """(rows with their state after the last assignment, centroids, distances evaluated in each assignment)."""
    c = first_centroids(vectors, key, column, clusters, width, scale)
    if not len(c):
        return None, c, []
    groups = group_centroids(c)
    keep = [x for x in keep if x not in RESULTS]
    rows = vectors.select((F.struct(*keep) if keep else F.lit(0)).alias("_row"), F.col(column).alias("_v"))
    state, evaluated = cut(_step(rows, c, groups, None, width, scale), "bounds"), []
    for _ in range(rounds):

        def add(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            yield b.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64), integers(b.column("_v"), width, scale)[2]

        counts, sums = summed(state, ["cluster", "_v"], width, add, (len(c),))
        new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], c)
        moved = above(((new - c) ** 2).sum(1))
        then, c = state, new
        evaluated.append(then.agg(F.sum("_scanned")).first()[0] or 0)
        state = cut(_step(then, c, groups, moved, width, scale), "bounds")
        drop(then)
    evaluated.append(state.agg(F.sum("_scanned")).first()[0] or 0)
    return state, c, evaluated


def _distances(state: DataFrame, c: np.ndarray, width: int, scale: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, own = integers(b.column("_v"), width, scale)[2], b.column("cluster").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("cluster"), pa.array(((x - c[own]) ** 2).sum(1))], ["_row", "cluster", "distance"])

    return state.select("_row", "_v", "cluster").mapInArrow(make, with_fields(state, ["_row"], "cluster int, distance long"))


def cluster(vectors: DataFrame, keep: list[str], key: str = "vec_id", column: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``keep``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    keep = [x for x in keep if x not in RESULTS]
    state, c, _ = fit(vectors, keep, key, column, clusters, rounds, width, scale)
    if state is None:
        return vectors.where("false").select(*keep, *[F.lit(None).cast(t).alias(n) for n, t in zip(RESULTS, ("int", "long", "long", "long", "string"), strict=True)])
    placed = cut(_distances(state, c, width, scale), "placed")
    drop(state)
    digest = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in c.tolist()]
    sums = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = [(k, s, sum(sums.values()), digest[k]) for k, s in sums.items()]
    spark: SparkSession = vectors.sparkSession
    of = spark.createDataFrame(facts, "_c int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = placed.join(F.broadcast(of), F.col("cluster") == F.col("_c"))
    return out.select(*(["_row.*"] if keep else []), *RESULTS)
