"""Scalar expressions over file names, sizes and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.sources.schemas import SUFFIXES


def basename(path: Column) -> Column:
    """Last part of a path with either separator."""
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"/?[^/]*$", "")


def suffix(name: Column) -> Column:
    """Lower-cased suffix with its dot; none for a name that only begins with a dot."""
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(basename(name), r"(?<=[^/])\.[^./]+$", "")


def allowed(name: Column) -> Column:
    return suffix(name).isin(*SUFFIXES)


def prefixed(code: Column, name: Column) -> Column:
    return F.concat(code, F.lit("__"), name)


def dataset_code(name: Column) -> Column:
    """Upper-cased ``DS`` and digits before the first ``__``, else ``unknown``."""
    found = F.upper(F.regexp_extract(name, r"(?i)^(DS[0-9]+)__", 1))
    return F.when(found == "", F.lit("unknown")).otherwise(found)


def source_type(name: Column, role: Column) -> Column:
    """A name's own marks come first, then what the role says."""
    low, kind = F.lower(name), F.lower(F.coalesce(role, F.lit("")))
    return (
        F.when(low.contains("__topup") | (kind == "augmented_topup"), "synthetic_topup")
        .when(low.contains("__aug") | (kind == "augmented"), "synthetic_augmented")
        .when(kind.isin("unique", "canonical"), "original")
        .otherwise("unknown")
    )


def size_category(width: Column, height: Column) -> Column:
    shorter = F.least(width, height)
    return F.when(shorter < 200, "small").when(shorter < 500, "medium").when(shorter.isNotNull(), "large")


def aspect_ratio(width: Column, height: Column) -> Column:
    return F.round(F.try_divide(width.cast("double"), height.cast("double")), 3)


def tolerant_int(text: Column) -> Column:
    """Blank, ``_`` and whatever isn't a number count as 0."""
    return F.coalesce(F.trim(text).try_cast("long"), F.lit(0).cast("long"))


def augmented_name(name: Column, i: Column, cluster: Column) -> Column:
    return F.concat(stem(name), F.lit("__aug"), i.cast("string"), F.lit("_"), cluster, suffix(name))


def topup_name(name: Column, variant: Column, i: Column) -> Column:
    return F.concat(stem(name), F.lit("__topup"), variant.cast("string"), F.lit("_"), i.cast("string"), suffix(name))


def base_role(role: Column) -> Column:
    """The role before any remark in parentheses."""
    return F.substring_index(role, " (", 1)


def blank_as_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def flag_text(flag: Column) -> Column:
    return F.initcap(flag.cast("string"))


def joined_set(values: Column) -> Column:
    """Distinct values, sorted, with bars between."""
    return F.array_join(F.array_sort(F.collect_set(values)), "|")
