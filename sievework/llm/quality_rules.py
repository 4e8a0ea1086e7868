"""Quality rules: plain text statistics and robust multivariate outliers, in DataFrame operations.

Every document has counts of words, symbols, repeated lines and repeated 8-word windows. Four
transformed statistics of the documents that pass the plain rules are modelled for each language
and source by minimum-covariance-determinant estimates: from each of four first estimates,
concentration steps keep the ``SUPPORT`` share of points nearest by Mahalanobis distance and refit
on them; the start that comes to the smallest determinant is taken further. A group's
estimates are blended with its language's by the number of rows, so that a group of a few
documents isn't its own measure, and a document is rejected where its squared distance is above
``CUTOFF``.

Defined results: a null or empty text has counts of 0 and fails the base rule; its verdict is
false. A null language or source is a group like others. Repeated rows count each. An empty table
gives an empty result. Very long texts need memory for the words of one text.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement as pairs_of
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import cut, words

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
SUPPORT = 0.75
#: Concentration steps that every start takes, and further ones of the start with the smallest determinant.
STEPS, LAST_STEPS = 2, 2
#: Covariance of the central 75 % of a 4-variate normal, scaled back: 0.75 / P(chi2_6 <= 5.385).
CONSISTENCY = 1.486
#: Added to the variances: the least spread that a statistic is taken to have.
RIDGE = (0.05**2, 0.30**2, 0.90**2, 0.50**2)
#: Rows that the language's estimates count as, when they are blended with a group's.
PRIOR_ROWS = 50.0
#: Squared distance beyond which a document is an outlier: the 0.99 quantile of chi-square with 4 degrees of freedom.
CUTOFF = 13.277
X = ("x0", "x1", "x2", "x3")
K = len(X)
PAIRS = list(pairs_of(range(K), 2))
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the columns of ``BASE``."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    filled = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(*keep, "_text", words(F.col("_text")).alias("_words"), filled.alias("_lines"))
    rows = rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    starts = F.sequence(F.lit(1), F.size("_h") - WINDOW + 1)
    windows = F.when(F.size("_h") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("_h", i, WINDOW))))
    rows = rows.select(*keep, *BASE[:4], windows.alias("_w"))
    again = F.size("_w") > F.size(F.array_distinct("_w"))
    ordered = F.when(again, F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.select(*keep, *BASE[:4], ordered.alias("_s"))
    equal = lambda x, i: F.coalesce(F.get("_s", i)["h"] == x["h"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter("_s", lambda x, i: equal(x, i - 1) | equal(x, i + 1)), lambda x: x["i"]))
    rows = rows.select(*keep, *BASE[:4], twice.alias("_p"))
    # each such window adds the words that the window before it hasn't covered
    new = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), p - F.coalesce(F.get("_p", i - 1), p - WINDOW)))
    covered = F.coalesce(F.aggregate(new, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    rows = rows.select(*keep, *BASE[:4], covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def with_vector(stats: DataFrame) -> DataFrame:
    """Add the modelled statistics: mean word length, symbols, repeats and repeated lines per word, each drawn to a usual value in short texts."""
    n = F.col("n_words") + 40
    return stats.withColumns({
        "x0": F.log((F.col("word_chars") + 40 * 5) / n),
        "x1": F.log(1 + 100 * F.col("n_symbols") / n),
        "x2": F.log(1 + 100 * F.col("n_repeat_words") / n),
        "x3": F.log(1 + 100 * F.col("n_dup_lines") / n),
    })


def _matched(points: DataFrame, fit: DataFrame, keys: list[str]) -> DataFrame:
    fit = fit.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in fit.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return points.join(fit, on).drop(*[f"_k_{k}" for k in keys])


def _minor(rows: tuple[int, ...], cols: tuple[int, ...]) -> str:
    """SQL of the determinant of these rows and columns of the covariance ``c*``, along its first row."""
    if not rows:
        return "1D"
    terms = [f"{'-' if k % 2 else '+'} c{min(rows[0], j)}{max(rows[0], j)} * ({_minor(rows[1:], cols[:k] + cols[k + 1 :])})" for k, j in enumerate(cols)]
    return " ".join(terms)


def determinant() -> Column:
    """Of the covariance ``c*``."""
    return F.expr(_minor(tuple(range(K)), tuple(range(K))))


def with_inverse(fit: DataFrame) -> DataFrame:
    """Add ``v*``, the inverse of the covariance ``c*`` by cofactors: once an estimate, not once a point."""
    but = lambda i: tuple(k for k in range(K) if k != i)
    cofactors = [f"{(-1) ** (i + j)} * ({_minor(but(i), but(j))}) / _det AS v{i}{j}" for i, j in PAIRS]
    return fit.withColumn("_det", determinant()).selectExpr("*", *cofactors).drop("_det")


def distance() -> Column:
    """Squared Mahalanobis distance of X from ``m*`` under the inverse covariance ``v*``."""
    return F.expr(" + ".join(f"{1 if i == j else 2} * v{i}{j} * ({X[i]} - m{i}) * ({X[j]} - m{j})" for i, j in PAIRS))


def _starts(points: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, start, m0..m3, c00..c33``: four first estimates of each group, all from sums over points scaled by median and quartiles.

    Quartile spreads alone (0), these with the correlations of tanh scores (1) or of directions from
    the median (2), and mean and covariance weighted by 1 / (1 + squared distance from the median) (3).
    """
    middle = [F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, x in enumerate(X)]
    spread = lambda i: F.sqrt(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + RIDGE[i])
    scale = points.groupBy(*keys).agg(*middle).select(*keys, *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(K)], *[spread(i).alias(f"s{i}") for i in range(K)])
    rows = _matched(points, cut(scale, "scale"), keys)
    rows = rows.select(*keys, *[f"m{i}" for i in range(K)], *[f"s{i}" for i in range(K)], *[((F.col(x) - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i, x in enumerate(X)])
    far = reduce(add, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(K)])
    rows = rows.withColumns({"w": 1 / (1 + far), "r": 1 / F.sqrt(far + 1e-9)}).withColumns({f"t{i}": F.tanh(f"z{i}") for i in range(K)})
    of = lambda form, i: {"t": F.col(f"t{i}"), "u": F.col(f"z{i}") * F.col("r")}[form]
    sums = [F.avg(of(f, i) * of(f, j)).alias(f"{f}{i}{j}") for f in "tu" for i, j in PAIRS]
    sums += [(F.sum(F.col("w") * F.col(f"z{i}")) / F.sum("w")).alias(f"a{i}") for i in range(K)]
    sums += [(F.sum(F.col("w") * F.col(f"z{i}") * F.col(f"z{j}")) / F.sum("w")).alias(f"b{i}{j}") for i, j in PAIRS]
    both = rows.groupBy(*keys).agg(*[F.first(c).alias(c) for i in range(K) for c in (f"m{i}", f"s{i}")], *sums)
    s = lambda i, j: F.col(f"s{i}") * F.col(f"s{j}")
    # drawn a little to 0, so that statistics that are one another's multiples still have an inverse
    tied = lambda f, i, j: 0.95 * F.col(f"{f}{i}{j}") / F.sqrt((F.col(f"{f}{i}{i}") + 1e-6) * (F.col(f"{f}{j}{j}") + 1e-6))
    plain = [F.col(f"m{i}").alias(f"m{i}") for i in range(K)]
    found = [F.struct(*plain, *[(s(i, j) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS])]
    found += [F.struct(*plain, *[(s(i, j) * (F.lit(1.0) if i == j else tied(f, i, j))).alias(f"c{i}{j}") for i, j in PAIRS]) for f in "tu"]
    mean = [(F.col(f"m{i}") + F.col(f"s{i}") * F.col(f"a{i}")).alias(f"m{i}") for i in range(K)]
    found += [F.struct(*mean, *[(s(i, j) * (F.col(f"b{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}")) + (RIDGE[i] if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS])]
    return both.select(*keys, F.posexplode(F.array(*found)).alias("start", "_e")).select(*keys, "start", "_e.*")


def _concentrated(points: DataFrame, fit: DataFrame, keys: list[str], support: float, steps: int) -> DataFrame:
    """``fit`` after concentration steps, each start for itself, with ``n`` points kept."""
    every = [*keys, "start"]
    for _ in range(steps):
        fit = cut(with_inverse(fit), "fit")
        near = _matched(points, fit, keys).withColumn("d2", distance())
        edge = near.groupBy(*every).agg(F.percentile_approx("d2", support, 1000).alias("edge"))
        near = _matched(near, cut(edge, "edge"), every).where("d2 <= edge")
        d = [f"({x} - m{i})" for i, x in enumerate(X)]
        means = [F.expr(f"avg({d[i]}) AS d{i}") for i in range(K)] + [F.expr(f"avg({d[i]} * {d[j]}) AS e{i}{j}") for i, j in PAIRS]
        sums = near.groupBy(*every).agg(F.count(F.lit(1)).alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(K)], *means)
        spread = [f"(e{i}{j} - d{i} * d{j}) * {CONSISTENCY}D + {RIDGE[i] if i == j else 0.0:.9f}D AS c{i}{j}" for i, j in PAIRS]
        fit = sums.selectExpr(*every, "n", *[f"m{i} + d{i} AS m{i}" for i in range(K)], *spread)
    return fit


def mcd(points: DataFrame, keys: list[str], support: float = SUPPORT, steps: int = STEPS, last_steps: int = LAST_STEPS) -> DataFrame:
    """``keys, start, n, m0..m3, c00..c33``: a row per group. Rows are only summed by group, copies of a group never meet."""
    tried = cut(_concentrated(points, _starts(points, keys), keys, support, steps), "fit")
    own = [c for c in tried.columns if c not in keys]
    best = tried.groupBy(*keys).agg(F.min_by(F.struct(*own), F.struct(determinant(), "start")).alias("_b")).select(*keys, "_b.*")
    return cut(_concentrated(points, best, keys, support, last_steps), "fit")


def judge(docs: DataFrame, keep: list[str], cutoff: float = CUTOFF) -> DataFrame:
    """``keep``, the columns of ``BASE``, ``distance`` (squared, null where the base rule failed) and ``kept``.

    Input columns of these names give way.
    """
    groups = ["_lang", "_source"]
    keep = [c for c in keep if c not in {*BASE, "distance", "kept"}]
    rows = docs.select(F.struct(*keep).alias("_row"), F.col("lang").alias("_lang"), F.col("source").alias("_source"), "text")
    stats = cut(with_vector(text_statistics(rows, ["_row", *groups])), "statistics")
    points = stats.where("not base_failed")
    # every point counts in its group and in its language; both are fitted by the same jobs
    level = lambda source, whole: F.struct(source.alias("_source"), F.lit(whole).alias("_whole"))
    nowhere = F.lit(None).cast(points.schema["_source"].dataType)
    levels = points.select("_lang", *X, F.inline(F.array(level(F.col("_source"), False), level(nowhere, True))))
    fits = mcd(levels, [*groups, "_whole"])
    own, wide = fits.where("not _whole").drop("_whole"), fits.where("_whole")
    names = [f"m{i}" for i in range(K)] + [f"c{i}{j}" for i, j in PAIRS]
    both = _matched(own, wide.select("_lang", *[F.col(c).alias(f"w_{c}") for c in names]), groups[:1])
    blend = lambda c: ((F.col("n") * F.col(c) + PRIOR_ROWS * F.col(f"w_{c}")) / (F.col("n") + PRIOR_ROWS)).alias(c)
    fit = cut(with_inverse(both.select(*groups, *[blend(c) for c in names])), "blend")
    passed = _matched(points, fit, groups).withColumn("distance", distance())
    failed = stats.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    columns = ["_row.*", *BASE, "distance"]
    out = passed.select(*columns).unionByName(failed.select(*columns))
    return out.withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("distance") <= cutoff), F.lit(False)))
