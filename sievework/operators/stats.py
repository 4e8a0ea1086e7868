"""Statistics of a curated collection and their warning flags. Every function is a few small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SOURCE_SHARE = 0.60
SMALL_SKEW, SMALL_LEAST = 1.5, 0.05
FLAG_SKEW, FLAG_LEAST = 2.0, 0.02


def inventory(df: DataFrame, source: str, label: str, kind: Column, empty: Column) -> DataFrame:
    """Per source and label, per source, and in all: items, labels that have any, empty items, kinds.

    ``level`` is 0 for a source's label, 1 for a source, 3 for all.
    """
    rows = df.select(F.col(source), F.col(label), kind.alias("_kind"), empty.alias("_empty"))
    out = rows.rollup(source, label).agg(
        F.grouping_id().cast("long").alias("level"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(label).alias("labels"),
        F.count_if("_empty").alias("empty"),
        F.array_join(F.array_sort(F.collect_set("_kind")), "|").alias("kinds"),
    )
    return out


def distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def contribution(df: DataFrame, label: str, source: str) -> DataFrame:
    """Items of each source in all (null label) and by label; ``of_label`` tells the two apart."""
    per = df.groupBy(label, source).agg(F.count(F.lit(1)).alias("n"))
    both = per.select(label, source, "n", F.lit(True).alias("of_label"))
    return both.unionByName(per.groupBy(source).agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias(label), source, "n", F.lit(False).alias("of_label")))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Largest and smallest label (ties to the first by name), their ratio and the mean."""
    d = distribution(df, label)
    return d.agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("l"))).alias("_hi"),
        F.min(F.struct("n", F.col(label).alias("l"))).alias("_lo"),
        F.avg("n").alias("mean_per_label"),
    ).select(
        F.col("_hi.l").alias("largest"), (-F.col("_hi.n")).alias("largest_n"), F.col("_lo.l").alias("smallest"), F.col("_lo.n").alias("smallest_n"),
        F.try_divide((-F.col("_hi.n")).cast("double"), F.col("_lo.n").cast("double")).alias("ratio"), "mean_per_label",
    )


def source_concentration(df: DataFrame, label: str, source: str, least: float = SOURCE_SHARE) -> DataFrame:
    """Each label's dominant source, its share and whether that is ``least`` or more."""
    per = df.groupBy(label, source).agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy(label).agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("n"), F.col(source).alias("s"))).alias("_t"))
    share = -F.col("_t.n") / F.col("total")
    return top.select(label, F.col("_t.s").alias("source"), (-F.col("_t.n")).alias("n"), share.alias("share"), (share >= least).alias("flagged"))


def crosstab(df: DataFrame, label: str, by: str, values: list[str]) -> DataFrame:
    """Items of each label in the given values of ``by``, one column each, 0 where none."""
    return df.groupBy(label).agg(*[F.count_if(F.col(by) == v).alias(v) for v in values])


def skew(df: DataFrame, label: str, hit: Column, times: float, least: float) -> DataFrame:
    """Each label's share of hits beside that of all, flagged at ``times`` the whole's share and above ``least``."""
    per = df.select(F.col(label), F.coalesce(hit, F.lit(False)).cast("int").alias("_h")).groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum("_h").cast("long").alias("hits"))
    whole = Window.partitionBy()  # one row a label
    overall = F.sum("hits").over(whole) / F.sum("n").over(whole)
    share = F.col("hits") / F.col("n")
    out = per.select(label, "n", "hits", share.alias("share"), overall.alias("overall"))
    return out.withColumn("flagged", (F.col("overall") > 0) & (F.col("share") > least) & (F.col("share") >= times * F.col("overall")))


def real_and_synthetic(df: DataFrame, label: str, role: str) -> DataFrame:
    """Real, synthetic and all rows of each label; the real share is of all rows."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(role).isin("unique", "canonical")).alias("real"),
        F.count_if(F.col(role).isin("augmented", "augmented_topup")).alias("synthetic"),
    ).withColumn("real_share", F.col("real") / F.col("n"))


def stacked_base(counts: DataFrame, bar: str, part: str, n: str) -> DataFrame:
    """Where each part of a stacked bar begins. ``counts`` has one row a bar and part."""
    before = Window.partitionBy(bar).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bar, part, n, F.coalesce(F.sum(n).over(before), F.lit(0)).alias("base"))


def class_index(df: DataFrame, label: str) -> DataFrame:
    """Labels numbered from 0 in order; only the distinct labels are ranked."""
    return df.select(label).distinct().withColumn("class_index", (F.row_number().over(Window.orderBy(label)) - 1).cast("long"))


def tenths(a: int, b: int) -> str:
    """a / b to one decimal, halves up, in integers; 0.0 if there is nothing."""
    t = (20 * a + b) // (2 * b) if b else 0
    return f"{t // 10}.{t % 10}"


def percent(a: int, b: int) -> str:
    return f"{tenths(100 * a, b)} %"


def health_report(title: str, imbalance_row: dict, concentrated: list[str], skewed: list[str], flagged: list[str] | None = None, labels: list[tuple[str, int, int, int]] | None = None) -> str:
    """Markdown from small collected frames: a warning or an all-clear in each section; the last ones only if given.

    ``labels`` has label, rows, real and synthetic ones; total, mean, shares and a table by label come from it.
    """
    section = lambda name, found, clear: ["", f"## {name}", "", *([f"- warning: {x}" for x in found] or [f"- {clear}"])]
    lines = [f"# {title}", "", "## Imbalance", "", f"- largest: {imbalance_row['largest']} ({imbalance_row['largest_n']})", f"- smallest: {imbalance_row['smallest']} ({imbalance_row['smallest_n']})", f"- ratio: {round(imbalance_row['ratio'] or 0, 2)}"]
    lines += section("Source concentration", concentrated, "no label leans on one source") + section("Skew", skewed, "no label stands out")
    if flagged is not None:
        lines += section("Flagged items", flagged, "no label has many")
    if labels is not None:
        total, real, synthetic = (sum(r[i] for r in labels) for i in (1, 2, 3))
        lines += ["", "## Composition", "", f"- all: {total}", f"- mean per label: {tenths(total, len(labels))}", f"- real: {real} ({percent(real, total)})", f"- synthetic: {synthetic} ({percent(synthetic, total)})"]
        lines += ["", "## Labels", "", "| label | items | share | real | synthetic |", "|-|-|-|-|-|", *[f"| {k} | {n} | {percent(n, total)} | {percent(r, n)} | {percent(s, n)} |" for k, n, r, s in sorted(labels)]]
    return "\n".join(lines) + "\n"
