"""Dealing the training part to clients, evenly or with Dirichlet-skewed shares."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sievework.functions.names import basename
from sievework.operators.joins import shuffled
from sievework.operators.split import allot

#: Tries of a rejection sampler.
TRIES = 16


def iid_targets(clusters: DataFrame, label: str, size: str, clients: int) -> DataFrame:
    """An equal share of each label for each client."""
    total = clusters.groupBy(label).agg(F.sum(size).alias("_t"))
    return total.select(label, F.array(*[F.lit(str(i)) for i in range(clients)]).alias("bins"), F.array_repeat(F.col("_t") / F.lit(clients), clients).alias("goals"))


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on its parts alone: 52 bits of their MD5."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def gamma(alpha: float, *key: Column) -> Column:
    """A gamma variate of shape ``alpha`` by rejection from a normal (Marsaglia and Tsang), a try a counter, rounded to 9 places.

    At least 95 of 100 tries are accepted, so that all ``TRIES`` fail once in 10^20 draws; then the mode stands in.
    """
    shape = alpha + 1 if alpha < 1 else alpha
    d = shape - 1 / 3
    c = 1 / math.sqrt(9 * d)

    def attempt(i: Column) -> Column:
        normal = F.sqrt(-2 * F.log(uniform(*key, i, F.lit("r")))) * F.cos(2 * math.pi * uniform(*key, i, F.lit("t")))
        root = 1 + c * normal
        v = root * root * root
        ok = (root > 0) & (F.log(uniform(*key, i, F.lit("u"))) < 0.5 * normal * normal + d - d * v + d * F.log(F.greatest(v, F.lit(1e-300))))
        return F.when(ok, d * v)

    tries = F.filter(F.transform(F.sequence(F.lit(1), F.lit(TRIES)), attempt), lambda x: x.isNotNull())
    drawn = F.coalesce(F.get(tries, F.lit(0)), F.lit(d))
    return F.round(drawn * F.pow(uniform(*key, F.lit("p")), F.lit(1 / alpha)) if alpha < 1 else drawn, 9)


def dirichlet_shares(labels: DataFrame, label: str, clients: int, alpha: float = 0.5, least: float = 0.02, seed: int = 42) -> DataFrame:
    """``labels`` with ``shares``: a Dirichlet draw, raised to ``least`` and scaled to 1 again; equal shares if all draws are 0.

    After scaling a share can be below ``least``. The draw depends on seed, label and client alone, so it is made where the
    label's row is, in any partitioning.
    """
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    d = labels.withColumn("_drawn", F.transform(F.sequence(F.lit(0), F.lit(clients - 1)), lambda i: gamma(alpha, F.lit(seed), F.col(label), i)))
    d = d.withColumn("_raised", F.transform("_drawn", lambda g: F.greatest(F.coalesce(F.try_divide(g, total("_drawn")), F.lit(1.0)), F.lit(least))))
    return d.withColumn("shares", F.transform("_raised", lambda s: s / total("_raised"))).drop("_drawn", "_raised")


def dirichlet_targets(clusters: DataFrame, label: str, size: str, clients: int, alpha: float = 0.5, least: float = 0.02, seed: int = 42) -> DataFrame:
    """Targets from a draw for each label."""
    total = dirichlet_shares(clusters.groupBy(label).agg(F.sum(size).alias("_t")), label, clients, alpha, least, seed)
    return total.select(label, F.array(*[F.lit(str(i)) for i in range(clients)]).alias("bins"), F.transform("shares", lambda s: s * F.col("_t")).alias("goals"))


def assign(rows: DataFrame, label: str, cluster: str, targets, seed: int = 42) -> DataFrame:
    """``rows`` with ``client_id``: each cluster of a label goes to one client. ``targets`` makes the goals from the clusters."""
    c = rows.groupBy(label, cluster).agg(F.count(F.lit(1)).alias("_n"))
    found = allot(c, [label], cluster, "_n", targets(c, label, "_n"), seed)
    found = found.select(F.col(label).alias("_l"), F.col(cluster).alias("_c"), F.col("bin").cast("int").alias("client_id"))
    return rows.join(shuffled(found), F.col(label).eqNullSafe(F.col("_l")) & F.col(cluster).eqNullSafe(F.col("_c"))).drop("_l", "_c")


def distribution(assigned: DataFrame, label: str) -> DataFrame:
    """Rows by client and label, by client, by label, and in all (null where summed)."""
    return assigned.cube("client_id", label).agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"))


def write_clients(assigned: DataFrame, label: str, path: str, clients: int, name: str | None = None) -> DataFrame:
    """Write one folder a client and label; ``client_id, copied``: rows that the writing job itself has counted.

    ``name``, if given, is a path column, rewritten below the client's folder from its base name. Rows without
    a client are written and counted under null. The counts are one row a client and need no second job over the rows.
    """
    out = assigned
    if name:
        folder = F.concat_ws("/", F.concat(F.lit("client_"), F.col("client_id")), F.coalesce(F.col(label), F.lit("unknown")), basename(F.col(name)))
        out = out.withColumn(name, F.when(F.col(name).isNotNull(), folder))
    seen = Observation()
    counts = [F.count_if(F.col("client_id") == i).alias(f"n{i}") for i in range(clients)] + [F.count_if(F.col("client_id").isNull()).alias("none")]
    out.observe(seen, *counts).write.mode("overwrite").partitionBy("client_id", label).parquet(path)
    got = seen.get
    rows = [(i, got[f"n{i}"]) for i in range(clients)] + ([(None, got["none"])] if got["none"] else [])
    return assigned.sparkSession.createDataFrame(rows, "client_id int, copied long")
