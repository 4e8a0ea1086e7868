"""Status and tier cascades, flag rechecks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.sources.schemas import REJECTED, STATUSES


def status(corrupt: Column, unreadable: Column, wrong_format: Column, too_small: Column) -> Column:
    """The first that holds."""
    return F.when(corrupt, "corrupt").when(unreadable, "unreadable").when(wrong_format, "wrong_format").when(too_small, "too_small").otherwise("ok")


def accepted(state: Column) -> Column:
    """A missing status is ok, a wrong format is kept."""
    return ~F.coalesce(state, F.lit("ok")).isin(*REJECTED)


def attributes(df: DataFrame, state: str, columns: list[str]) -> DataFrame:
    """Blank ``columns`` of rows that were rejected; the rows stay."""
    ok = accepted(F.col(state))
    return df.withColumns({c: F.when(ok, F.col(c)) for c in columns})


def histogram(df: DataFrame, column: str, values: tuple[str, ...] = STATUSES, out: str = "n") -> DataFrame:
    """Rows of each value, 0 for those that don't occur. ``values`` is a short fixed list."""
    found = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    known = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return known.join(found, column, "left").select(column, F.coalesce("_n", F.lit(0)).alias(out))


def tier(same_bytes: Column, similarity: Column, least: float = 0.95) -> Column:
    """Equal bytes first, then structural similarity; unknown bytes never match."""
    return F.when(F.coalesce(same_bytes, F.lit(False)), "byte_identical").when(similarity.isNull(), "comparison_failed").when(similarity >= least, "high_ssim_match").otherwise("low_ssim_different")


def recheck(df: DataFrame, state: str, old: str, measured: str) -> DataFrame:
    """Add ``new_flag`` and ``method``: rows that aren't ok are skipped, unreadable ones keep the old flag."""
    ok = F.col(state) == "ok"
    method = F.when(~ok, "skipped_not_ok").when(F.col(measured).isNull(), "unreadable_at_recheck").when(F.col(measured), "channel_analysis").otherwise("not_grayscale")
    return df.withColumns({"new_flag": F.when(ok, F.coalesce(measured, old)).otherwise(F.col(old)), "method": method})
