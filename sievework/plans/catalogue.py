"""The registered queries of the curation operators over the driver's tables, each with its SQL counterpart.

Stand-ins: a document is an item, its language the label, its source the source collection, its
number of characters the size, ``labels.toxic`` the audited flag. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import hashing, images, names
from sievework.operators import access, dedup, federate, quality, reconcile, select, split, stats
from sievework.operators.joins import same_keys
from sievework.sources import chunks, files, infer, sheets, versions
from sievework.sources.schemas import SPLIT_SHARES, STATUSES, SUFFIXES
from sievework.sources.shared import arrow_rows, cut, new_path, table
from sievework.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SELECTED = ["de", "en", "es", "it"]
FLOOR = 140
CLIENTS = 4


def query(sql: str | None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = d.join(lab, "doc_id", "left")
    return joined.select(F.col("doc_id").alias("ord"), F.col("lang").alias("label"), "source", F.col("n_chars").alias("size"), "text", "quality", "toxic")


ITEMS = """items AS (SELECT d.doc_id AS ord, d.lang AS label, d.source, d.n_chars AS size, d.text, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l USING (doc_id))"""
CATEGORY = "CASE WHEN size < 200 THEN 'small' WHEN size < 500 THEN 'medium' WHEN size IS NOT NULL THEN 'large' END"
ROLE = "CASE WHEN toxic = 1 THEN 'augmented_topup' WHEN quality = 0 THEN 'augmented' WHEN quality = 1 THEN 'unique' ELSE 'discovered_unlisted' END"


def category() -> F.Column:
    return names.size_category(F.col("size"), F.col("size"))


def role() -> F.Column:
    return F.expr(ROLE)


# -- inventory and reconciliation ------------------------------------------------------------


@query(f"""WITH {ITEMS} SELECT source, label, GROUPING(source, label)::BIGINT AS level, count(*) AS n,
    count(DISTINCT label) AS labels, count(*) FILTER (WHERE coalesce(size, 0) = 0) AS empty,
    coalesce(string_agg(DISTINCT {CATEGORY}, '|' ORDER BY {CATEGORY}), '') AS kinds
    FROM items GROUP BY ROLLUP (source, label)""")
def inventory_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.inventory(items(spark, sf_dir), "source", "label", category(), F.coalesce("size", F.lit(0)) == 0)


def _counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Counts by source and label, and a second account of them with known errors."""
    base = table(spark, sf_dir, "documents").groupBy("source", F.col("lang").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("k"))
    manual = base.where("k % 5 <> 0").select("source", "label", F.when(F.col("k") % 3 == 0, F.col("n") + F.col("k") % 4).otherwise(F.col("n")).alias("n"))
    # two labels' counts exchanged, and one that only this account has
    other = F.when(F.col("label") == "de", "fr").when(F.col("label") == "fr", "de").otherwise(F.col("label"))
    manual = manual.withColumn("label", F.when(F.col("source") == "src4", other).otherwise(F.col("label")))
    extra = base.select("source").distinct().select("source", F.lit("it").alias("label"), (F.length("source") - 4).cast("long").alias("n"))
    return base.select("source", "label", "n"), manual.unionByName(extra)


COUNTS = """base AS (SELECT source, lang AS label, count(*) AS n, min(doc_id) AS k FROM documents GROUP BY 1, 2),
  manual AS (SELECT source, CASE WHEN source = 'src4' AND label = 'de' THEN 'fr' WHEN source = 'src4' AND label = 'fr' THEN 'de' ELSE label END AS label,
      CASE WHEN k % 3 = 0 THEN n + k % 4 ELSE n END AS n FROM base WHERE k % 5 <> 0
    UNION ALL SELECT DISTINCT source, 'it', (length(source) - 4)::BIGINT FROM base),
  diffs AS (SELECT * FROM (SELECT coalesce(a.source, b.source) AS source, coalesce(a.label, b.label) AS label, a.n AS scripted, b.n AS manual, a.n - b.n AS diff,
      CASE WHEN a.n IS NULL AND b.n <> 0 THEN 'excel_only' WHEN b.n IS NULL AND a.n <> 0 THEN 'script_only' WHEN a.n <> b.n THEN 'mismatch' END AS kind
    FROM base a FULL JOIN manual b ON a.source IS NOT DISTINCT FROM b.source AND a.label IS NOT DISTINCT FROM b.label) WHERE kind IS NOT NULL)"""


def _differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _counts(spark, sf_dir)
    return reconcile.compare_counts(a, b, ["source", "label"], "n")


@query(f"WITH {COUNTS} SELECT * FROM diffs")
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(spark, sf_dir).orderBy("source", F.abs("diff").desc_nulls_last())


@query(f"WITH {COUNTS} SELECT kind, count(*) AS n, sum(abs(coalesce(diff, scripted, manual)))::BIGINT AS apart FROM diffs GROUP BY kind")
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.coalesce("diff", "scripted", "manual"))).alias("apart"))


@query(f"""WITH {COUNTS} SELECT d.source, least(d.label, m.label) AS label_a, greatest(d.label, m.label) AS label_b, min(d.scripted) AS n
    FROM diffs d JOIN manual m ON d.source = m.source AND d.scripted = m.n AND d.label <> m.label AND m.n <> 0 WHERE d.kind = 'mismatch' GROUP BY 1, 2, 3""")
def swap_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.swapped(_differences(spark, sf_dir), _counts(spark, sf_dir)[1], "source", "label", "n")


@query("""WITH c AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2),
  days AS (SELECT DISTINCT day FROM c), kinds(event_type) AS (VALUES ('click'), ('view'), ('purchase'), ('error'), ('none'))
  SELECT days.day::VARCHAR AS day, kinds.event_type, CASE WHEN coalesce(c.n, 0) % 7 = 0 THEN 0 ELSE coalesce(c.n, 0) END AS n
  FROM days CROSS JOIN kinds LEFT JOIN c ON c.day = days.day AND c.event_type = kinds.event_type""")
def wide_matrix_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide matrix of texts, some ``_`` or blank, back to long counts."""
    kinds = ["click", "view", "purchase", "error", "none"]
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("date").cast("string").alias("day"), "event_type")
    wide = e.groupBy("day").pivot("event_type", kinds).count()
    text = lambda k: F.when(F.col(k) % 7 == 0, "_").otherwise(F.concat(F.lit(" "), F.col(k).cast("string"), F.lit(" ")))
    wide = wide.select("day", *[text(k).alias(k) for k in kinds])
    return wide.unpivot(["day"], kinds, "event_type", "v").select("day", "event_type", names.tolerant_int(F.col("v")).alias("n"))


CODES = [(f"src{i}", f"DS{i + 1:02d}") for i in range(11)]
DIMENSION = "dim(source, code) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in CODES) + ")"
PLAN = f"""{DIMENSION}, plan AS (SELECT doc_id, d.lang AS label, code, code || '__doc' || doc_id || '.TXT' AS master_filename,
    CASE WHEN doc_id % 10 < 3 THEN 'skip' ELSE 'copy' END AS action FROM documents d JOIN dim USING (source))"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    dim = spark.createDataFrame(CODES, "source string, code string")
    named = d.join(F.broadcast(dim), "source").select("doc_id", F.col("lang").alias("label"), "code", names.prefixed(F.col("code"), F.concat(F.lit("doc"), F.col("doc_id"), F.lit(".TXT"))).alias("master_filename"))
    return reconcile.copy_plan(named, named.where("doc_id % 10 < 3"), "master_filename")


@query(f"WITH {PLAN} SELECT * FROM plan")
def merge_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)


@query(f"""WITH {PLAN} SELECT code, label, GROUPING(code, label)::BIGINT AS level, count(*) FILTER (WHERE action = 'copy') AS copied,
    count(*) FILTER (WHERE action = 'skip') AS skipped FROM plan GROUP BY ROLLUP (code, label)""")
def copy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).rollup("code", "label").agg(F.grouping_id().cast("long").alias("level"), F.count_if(F.col("action") == "copy").alias("copied"), F.count_if(F.col("action") == "skip").alias("skipped"))


@query(f"WITH {DIMENSION} SELECT d.source, count(*) AS n FROM documents d LEFT JOIN dim USING (source) WHERE code IS NULL GROUP BY 1")
def unmatched_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = spark.createDataFrame(CODES, "source string, code string")
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(dim), "source", "left_anti")


# -- validation ------------------------------------------------------------------------------

STATUS = """checked AS (SELECT doc_id, lang AS label, n_chars, CASE WHEN text IS NULL OR n_chars % 97 = 0 THEN 'corrupt' WHEN n_chars % 89 = 0 THEN 'unreadable'
    WHEN n_chars % 13 = 0 THEN 'wrong_format' WHEN n_chars < 50 THEN 'too_small' ELSE 'ok' END AS status FROM documents)"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    state = quality.status(F.col("text").isNull() | (n % 97 == 0), n % 89 == 0, n % 13 == 0, n < 50)
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), "n_chars", state.alias("status"))


@query(f"WITH {STATUS} SELECT * FROM checked")
def status_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir)


@query(f"WITH {STATUS}, s(status) AS (VALUES {', '.join(f"('{x}')" for x in STATUSES)}) SELECT s.status, count(c.doc_id) AS n FROM s LEFT JOIN checked c USING (status) GROUP BY 1")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.histogram(_checked(spark, sf_dir), "status")


@query(f"WITH {STATUS} SELECT c.doc_id, c.label FROM checked c LEFT JOIN (SELECT doc_id, status FROM checked WHERE doc_id % 4 <> 0) v USING (doc_id) WHERE coalesce(v.status, 'ok') NOT IN ('too_small', 'corrupt', 'unreadable')")
def valid_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without a report counts as ok; a wrong format is kept."""
    c = _checked(spark, sf_dir)
    report = c.where("doc_id % 4 <> 0").select("doc_id", "status")
    return c.drop("status").join(report, "doc_id", "left").where(quality.accepted(F.col("status"))).select("doc_id", "label")


NAMED = """named AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'ds' || doc_id % 12 || '__img' || doc_id || '.JPG' WHEN 1 THEN 'DS03__a__aug2_c1.png' WHEN 2 THEN 'x' || doc_id || '__TOPUP1_3.jpeg'
      WHEN 3 THEN 'dsx__b.webp' WHEN 4 THEN '.hidden' ELSE 'plain' || doc_id END AS name,
    CASE doc_id % 5 WHEN 0 THEN 'unique' WHEN 1 THEN 'canonical' WHEN 2 THEN 'augmented (too_small)' WHEN 3 THEN 'augmented' END AS role FROM documents)"""


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id").cast("string")
    six, five = F.col("doc_id") % 6, F.col("doc_id") % 5
    name = F.when(six == 0, F.concat(F.lit("ds"), (F.col("doc_id") % 12).cast("string"), F.lit("__img"), k, F.lit(".JPG"))).when(six == 1, "DS03__a__aug2_c1.png").when(six == 2, F.concat(F.lit("x"), k, F.lit("__TOPUP1_3.jpeg"))).when(six == 3, "dsx__b.webp").when(six == 4, ".hidden").otherwise(F.concat(F.lit("plain"), k))
    return d.select("doc_id", name.alias("name"), F.when(five == 0, "unique").when(five == 1, "canonical").when(five == 2, "augmented (too_small)").when(five == 3, "augmented").alias("role"))


@query(f"""WITH {NAMED} SELECT doc_id, name, CASE WHEN regexp_matches(upper(name), '^DS[0-9]+__') THEN upper(split_part(name, '__', 1)) ELSE 'unknown' END AS code,
    CASE WHEN contains(lower(name), '__topup') THEN 'synthetic_topup' WHEN contains(lower(name), '__aug') OR role = 'augmented' THEN 'synthetic_augmented'
      WHEN role IN ('unique', 'canonical') THEN 'original' ELSE 'unknown' END AS source_type,
    CASE WHEN name LIKE '_%.%' AND name <> '.hidden' THEN '.' || lower(split_part(name, '.', 2)) ELSE '' END AS suffix,
    CASE WHEN name = '.hidden' THEN name ELSE split_part(name, '.', 1) END AS stem, split_part(role, ' (', 1) AS base_role FROM named""")
def provenance_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = F.col("name"), F.col("role")
    return _named(spark, sf_dir).select("doc_id", "name", names.dataset_code(n).alias("code"), names.source_type(n, r).alias("source_type"), names.suffix(n).alias("suffix"), names.stem(n).alias("stem"), names.base_role(r).alias("base_role"))


@query("""SELECT doc_id, 'D:\\set ' || doc_id % 3 || '\\a, b\\doc' || doc_id || '.png' AS path, 'doc' || doc_id || '.png' AS base, 'D:/set ' || doc_id % 3 || '/a, b' AS folder,
    'doc' || doc_id || '__aug1_c7.png' AS aug, 'doc' || doc_id || '__topup2_5.png' AS topup, true AS allowed FROM documents""")
def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.concat(F.lit("D:\\set "), (F.col("doc_id") % 3).cast("string"), F.lit("\\a, b\\doc"), F.col("doc_id").cast("string"), F.lit(".png"))
    d = table(spark, sf_dir, "documents").select("doc_id", p.alias("path"))
    base = names.basename(F.col("path"))
    return d.select("doc_id", "path", base.alias("base"), names.parent(F.col("path")).alias("folder"), names.augmented_name(base, F.lit(1), F.lit("c7")).alias("aug"), names.topup_name(base, F.lit(2), F.lit(5)).alias("topup"), names.allowed(base).alias("allowed"))


@query("""SELECT doc_id, CASE WHEN least(n_chars, 600 - doc_id % 500) < 200 THEN 'small' WHEN least(n_chars, 600 - doc_id % 500) < 500 THEN 'medium' ELSE 'large' END AS category,
    round(n_chars::DOUBLE / nullif(doc_id % 9, 0)::DOUBLE, 3) AS ratio FROM documents""")
def size_and_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", names.size_category(F.col("n_chars"), 600 - F.col("doc_id") % 500).alias("category"), names.aspect_ratio(F.col("n_chars"), F.col("doc_id") % 9).alias("ratio"))


# -- exact and near duplicates ---------------------------------------------------------------

EXACT = """h AS (SELECT doc_id AS ord, source AS label, md5(text) AS hash FROM documents WHERE text IS NOT NULL),
  several AS (SELECT hash FROM h GROUP BY 1 HAVING count(DISTINCT label) > 1)"""


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("text is not null")
    return d.select(F.col("doc_id").alias("ord"), F.col("source").alias("label"), F.md5(F.col("text").cast("binary")).alias("hash"))


@query(f"WITH {EXACT} SELECT h.hash, h.ord, h.label FROM h JOIN several USING (hash)")
def exact_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.collisions(_hashed(spark, sf_dir), "hash", "label").select("hash", "ord", "label")


TIERS = f"""{EXACT}, groups AS (SELECT hash, label, count(*) AS c, min(ord) AS ord FROM h JOIN several USING (hash) GROUP BY 1, 2),
  tiers AS (SELECT a.hash, a.label AS label_a, b.label AS label_b, a.c * b.c AS pairs,
      CASE WHEN (a.ord + b.ord) % 5 <> 0 THEN 'byte_identical' WHEN (a.ord + b.ord) % 3 = 0 THEN 'comparison_failed' WHEN (a.ord + b.ord) % 20 / 20.0 >= 0.5 THEN 'high_ssim_match' ELSE 'low_ssim_different' END AS tier
    FROM groups a JOIN groups b ON a.hash = b.hash AND a.label < b.label)"""


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of labels that share a hash, with how many pairs of rows they stand for; members are counted, not paired."""
    g = dedup.collisions(_hashed(spark, sf_dir), "hash", "label").groupBy("hash", "label").agg(F.count(F.lit(1)).alias("c"), F.min("ord").alias("ord"))
    b = g.select(F.col("hash").alias("_h"), F.col("label").alias("label_b"), F.col("c").alias("c_b"), F.col("ord").alias("ord_b"))
    met = g.join(b, (F.col("hash") == F.col("_h")) & (F.col("label") < F.col("label_b")))
    k = F.col("ord") + F.col("ord_b")
    return met.select("hash", F.col("label").alias("label_a"), "label_b", (F.col("c") * F.col("c_b")).alias("pairs"), quality.tier(k % 5 != 0, F.when(k % 3 != 0, k % 20 / 20), 0.5).alias("tier"))


@query(f"WITH {TIERS} SELECT * FROM tiers")
def collision_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiers(spark, sf_dir)


@query(f"""WITH {TIERS}, n AS (SELECT tier, label_a, label_b, sum(pairs)::BIGINT AS pairs FROM tiers GROUP BY 1, 2, 3)
  SELECT tier, label_a, label_b, pairs, place FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY pairs DESC, label_a, label_b) AS place FROM n) WHERE place <= 10""")
def tier_pairs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _tiers(spark, sf_dir).groupBy("tier", "label_a", "label_b").agg(F.sum("pairs").alias("pairs"))
    return reconcile.ranked(n, ["tier"], [F.col("pairs").desc(), "label_a", "label_b"], "place").where("place <= 10").withColumn("place", F.col("place").cast("long"))


SIMHASH = r"""norm AS (SELECT doc_id AS ord, lang AS label, n_chars AS size, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[ \t\n\r]+', ' ', 'g')), ' ') AS w FROM documents),
  grams AS (SELECT ord, label, size, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM norm),
  vals AS (SELECT ord, label, size, ('0x' || substr(md5(g), 1, 16))::UBIGINT AS v FROM grams),
  bits AS (SELECT ord, label, size, b, 2 * sum(((v >> b) & 1)::INT) > count(*) AS one FROM vals, range(64) AS t(b) GROUP BY 1, 2, 3, 4),
  hashed AS (SELECT ord, label, size, sum(CASE WHEN one THEN 1::UBIGINT << b ELSE 0::UBIGINT END)::UBIGINT AS hash FROM bits GROUP BY 1, 2, 3),
  classes AS (SELECT label, hash, min(ord) AS rep, count(*) AS members FROM hashed GROUP BY 1, 2),
  pairs AS (SELECT a.label, a.rep AS rep_a, b.rep AS rep_b, bit_count(xor(a.hash, b.hash))::INT AS distance FROM classes a JOIN classes b ON a.label IS NOT DISTINCT FROM b.label AND a.rep < b.rep
    WHERE bit_count(xor(a.hash, b.hash)) <= 8)"""


def _simhashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    h = hashing.text_simhash(d, "doc_id", "text")
    with arrow_rows(spark, hashing.ARROW_ROWS):
        return cut(d.select("doc_id", "lang", "n_chars").join(h, "doc_id").select(F.col("doc_id").alias("ord"), F.col("lang").alias("label"), F.col("n_chars").alias("size"), "hash"), "simhash")


@query(f"WITH {SIMHASH} SELECT label, rep_a, rep_b, distance, CASE WHEN distance <= 4 THEN 'tight' ELSE 'loose' END AS kind FROM pairs")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = dedup.hash_classes(_simhashed(spark, sf_dir), ["hash"], "label", "ord")
    found = dedup.near_pairs(classes, "label", dedup.LOOSE)
    return found.withColumn("kind", F.when(F.col("distance") <= dedup.TIGHT, "tight").otherwise("loose"))


@query(f"""WITH {SIMHASH}, ends AS (SELECT rep_a AS rep, rep_b AS other, distance FROM pairs UNION ALL SELECT rep_b, rep_a, distance FROM pairs),
  n AS (SELECT e.rep, coalesce(sum(k.members) FILTER (WHERE distance <= 4), 0)::BIGINT AS tight, coalesce(sum(k.members) FILTER (WHERE distance > 4), 0)::BIGINT AS loose FROM ends e JOIN classes k ON k.rep = e.other GROUP BY 1)
  SELECT h.ord, h.label, k.rep AS class_id, k.members, coalesce(n.tight, 0) AS tight, coalesce(n.loose, 0) AS loose FROM hashed h JOIN classes k ON k.label IS NOT DISTINCT FROM h.label AND k.hash = h.hash LEFT JOIN n ON n.rep = k.rep""")
def near_dup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its class of equal hashes and how many documents of other classes it is linked with: a row a document, however many are alike."""
    d = _simhashed(spark, sf_dir)
    classes = cut(dedup.hash_classes(d, ["hash"], "label", "ord"), "classes")
    found = cut(dedup.near_pairs(classes, "label", dedup.LOOSE), "near")
    tight = dedup.degrees(classes, found.where(F.col("distance") <= dedup.TIGHT)).withColumnRenamed("links", "tight")
    loose = dedup.degrees(classes, found.where(F.col("distance") > dedup.TIGHT)).withColumnRenamed("links", "loose")
    facts = classes.join(tight, "rep").join(loose, "rep").select("label", "hash", F.col("rep").alias("class_id"), "members", "tight", "loose")
    return same_keys(d.select("ord", "label", "hash"), facts, ["label", "hash"]).drop("hash")


@query(f"WITH {SIMHASH} SELECT label, rep_a, rep_b, distance FROM pairs WHERE distance > 4")
def loose_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup_pairs(spark, sf_dir).where("kind = 'loose'").drop("kind")


@query("""WITH s AS (SELECT vec_id, label, list_sum(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN 1::HUGEINT << (64 - i) ELSE 0::HUGEINT END))::UBIGINT AS h,
      list_sum(list_transform(range(1, 65), lambda i: CASE WHEN list_reverse(embedding)[i] > 0 THEN 1::HUGEINT << (64 - i) ELSE 0::HUGEINT END))::UBIGINT AS f FROM embeddings WHERE embedding IS NOT NULL)
  SELECT a.label, a.vec_id AS query_id, b.vec_id AS found_id, least(bit_count(xor(a.h, b.h)), bit_count(xor(a.f, b.h)))::INT AS distance
  FROM s a JOIN s b ON a.label IS NOT DISTINCT FROM b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 AND least(bit_count(xor(a.h, b.h)), bit_count(xor(a.f, b.h))) <= 24""")
def near_dup_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stated query set (ids divisible by 20) against all vectors of the label, mirrored or not.

    Bands hold nothing apart at such a distance, so each query meets its label's vectors. Vectors of any width have a
    hash (values that aren't there count as not positive); a null vector has none. A null label is one like others.
    """
    e = table(spark, sf_dir, "embeddings").where("embedding is not null")
    s = e.select("vec_id", "label", hashing.sign_hash(F.col("embedding")).alias("h"), hashing.sign_hash(F.col("embedding"), True).alias("f"))
    q = s.where("vec_id % 20 = 0").select(F.col("label").alias("ql"), F.col("vec_id").alias("query_id"), F.col("h").alias("qh"), F.col("f").alias("qf"))
    d = F.least(hashing.hamming(F.col("qh"), F.col("h")), hashing.hamming(F.col("qf"), F.col("h")))
    return q.join(s, F.col("ql").eqNullSafe(F.col("label"))).where("query_id <> vec_id").select("label", "query_id", F.col("vec_id").alias("found_id"), d.alias("distance")).where("distance <= 24")


CLUSTERS = f"""{SIMHASH}, links AS (SELECT rep_a AS a, rep_b AS b FROM pairs WHERE distance <= 4 UNION SELECT rep_b, rep_a FROM pairs WHERE distance <= 4),
  reach AS (SELECT rep AS node, rep AS root FROM classes UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a),
  comp AS (SELECT node, min(root) AS component FROM reach GROUP BY 1),
  clustered AS (SELECT h.ord, h.label, h.size, c.component, concat_ws('_', h.label, dense_rank() OVER (PARTITION BY h.label ORDER BY c.component)) AS cluster_id
    FROM hashed h JOIN classes k ON h.label IS NOT DISTINCT FROM k.label AND h.hash = k.hash JOIN comp c ON c.node = k.rep)"""


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _simhashed(spark, sf_dir)
    classes = cut(dedup.hash_classes(d, ["hash"], "label", "ord"), "classes")
    return cut(dedup.clusters(d, classes, dedup.links(classes, "label", dedup.TIGHT), "label", "ord").select("ord", "label", "size", "component", "cluster_id"), "clusters")


@query(f"WITH RECURSIVE {CLUSTERS} SELECT ord, label, component, cluster_id FROM clustered")
def dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).drop("size")


ROLES = f"""{CLUSTERS}, s AS (SELECT *, (ord % 10)::DOUBLE AS sharp FROM clustered), t AS (SELECT *, max(sharp) OVER (PARTITION BY cluster_id) AS top, count(*) OVER (PARTITION BY cluster_id) AS c FROM s),
  e AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY CASE WHEN top = 0 OR sharp >= 0.3 * top THEN 0 ELSE 1 END, size DESC, ord) AS place FROM t),
  roles AS (SELECT ord, label, cluster_id, CASE WHEN c = 1 THEN 'unique' WHEN place = 1 THEN 'canonical'
    WHEN row_number() OVER (PARTITION BY cluster_id, place = 1 ORDER BY ord) <= 2 THEN 'augmented' ELSE 'dropped' END AS role FROM e)"""


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _clustered(spark, sf_dir).withColumn("sharp", (F.col("ord") % 10).cast("double"))
    return dedup.choose(d, "cluster_id", "ord", "size", "sharp", cap=2).select("ord", "label", "cluster_id", "role")


@query(f"WITH RECURSIVE {ROLES} SELECT * FROM roles")
def dedup_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical pick and capped keep."""
    return _roles(spark, sf_dir)


@query(f"WITH RECURSIVE {ROLES} SELECT label, role, GROUPING(label, role)::BIGINT AS level, count(*) AS n FROM roles GROUP BY GROUPING SETS ((role), (label, role), (label))")
def role_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roles(spark, sf_dir).withColumn("role", names.base_role(F.concat("role", F.when(F.col("ord") % 3 == 0, " (too_small)").otherwise(""))))
    return r.groupingSets([["role"], ["label", "role"], ["label"]], "label", "role").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"))


# -- selection, manifests --------------------------------------------------------------------

CHOSEN = f"""{ITEMS}, chosen AS (SELECT *, {ROLE} AS role FROM items WHERE label IN ({', '.join(repr(x) for x in SELECTED)})),
  per AS (SELECT label, count(*) AS n, count(*) FILTER (WHERE role = 'unique') AS u FROM chosen GROUP BY 1 HAVING count(*) < {FLOOR}),
  pool AS (SELECT c.label, c.ord AS source, row_number() OVER (PARTITION BY c.label ORDER BY c.ord) - 1 AS place FROM chosen c JOIN per USING (label) WHERE u = 0 OR role = 'unique'),
  wanted AS (SELECT label, CASE WHEN u > 0 THEN u ELSE n END AS m, unnest(range({FLOOR} - n)) AS i FROM per),
  added AS (SELECT w.label, w.i, p.source, w.i // w.m + 1 AS variant FROM wanted w JOIN pool p ON p.label = w.label AND p.place = w.i % w.m)"""


@query(f"WITH {CHOSEN} SELECT label, i, source, variant FROM added")
def select_and_topup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = select.selected(items(spark, sf_dir).withColumn("role", role()), "label", SELECTED)
    return select.top_up(kept, "label", "ord", "role", FLOOR)


@query(f"""WITH {CHOSEN}, rows AS (SELECT label FROM chosen UNION ALL SELECT label FROM added), s(label) AS (VALUES {', '.join(f"('{x}')" for x in SELECTED)})
  SELECT s.label, count(r.label) AS n FROM s LEFT JOIN rows r USING (label) GROUP BY ROLLUP (s.label)""")
def selection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = select.selected(items(spark, sf_dir).withColumn("role", role()), "label", SELECTED)
    both = kept.select("label").unionByName(select.top_up(kept, "label", "ord", "role", FLOOR).select("label"))
    return select.counts(both, "label", SELECTED)


CHANGES = """disk AS (SELECT doc_id FROM documents WHERE doc_id % 7 <> 3), corrupt AS (SELECT doc_id FROM documents WHERE doc_id % 50 = 3), seen AS (SELECT doc_id FROM disk UNION SELECT doc_id FROM corrupt),
  changes AS (SELECT doc_id, 'added_discovered_on_disk' AS change FROM seen WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT DISTINCT doc_id, 'removed_missing_from_disk' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM seen)
    UNION ALL SELECT doc_id, 'corrupt_kept_in_metadata_excluded_from_manifest' FROM corrupt)"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return reconcile.change_sets(d.where("doc_id % 7 <> 3"), table(spark, sf_dir, "labels").select("doc_id"), d.where("doc_id % 50 = 3"), "doc_id")


@query(f"WITH {CHANGES} SELECT * FROM changes")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir)


@query(f"""WITH {CHANGES}, q AS (SELECT d.doc_id, d.lang AS label, d.doc_id % 7 <> 3 AS moved FROM documents d WHERE doc_id IN (SELECT doc_id FROM changes WHERE change = 'added_discovered_on_disk'))
  SELECT doc_id, label, 'quarantine/' || doc_id AS target, moved FROM q WHERE moved UNION ALL SELECT doc_id, label, '', moved FROM q WHERE NOT moved""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    gone, _ = reconcile.quarantine(d, _changes(spark, sf_dir).where("change = 'added_discovered_on_disk'"), "doc_id")
    gone = gone.withColumn("target", F.concat(F.lit("quarantine/"), F.col("doc_id").cast("string")))
    return reconcile.move_log(gone, d.where("doc_id % 7 <> 3").select("doc_id"), "doc_id", "target")


@query(f"""WITH {CHANGES}, q AS (SELECT doc_id FROM changes WHERE change = 'added_discovered_on_disk')
  SELECT d.lang AS label, count(*) AS kept FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.doc_id NOT IN (SELECT doc_id FROM q) AND l.doc_id IS NOT NULL GROUP BY 1""")
def rebuilt_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    listed = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("old", F.lit("unique"))
    roles = d.join(listed, "doc_id", "left").withColumn("role", F.coalesce("old", F.lit("discovered_unlisted")))
    _, kept = reconcile.quarantine(roles, _changes(spark, sf_dir).where("change = 'added_discovered_on_disk'"), "doc_id")
    return kept.where("role <> 'discovered_unlisted'").groupBy("label").agg(F.count(F.lit(1)).alias("kept"))


# -- statistics ------------------------------------------------------------------------------


@query("SELECT lang AS label, count(*) AS n FROM documents GROUP BY 1")
def breed_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distribution(items(spark, sf_dir).select("label"), "label").orderBy(F.col("n").desc(), "label")


@query("SELECT lang AS label, source, count(*) AS n, true AS of_label FROM documents GROUP BY 1, 2 UNION ALL SELECT NULL, source, count(*), false FROM documents GROUP BY 2")
def contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.contribution(table(spark, sf_dir, "documents").select(F.col("lang").alias("label"), "source"), "label", "source")


@query("""WITH c AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY 1), hi AS (SELECT * FROM c ORDER BY n DESC, label LIMIT 1), lo AS (SELECT * FROM c ORDER BY n, label LIMIT 1)
  SELECT hi.label AS largest, hi.n AS largest_n, lo.label AS smallest, lo.n AS smallest_n, hi.n::DOUBLE / lo.n AS ratio, (SELECT avg(n) FROM c) AS mean_per_label FROM hi, lo""")
def imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.imbalance(table(spark, sf_dir, "documents").select(F.col("lang").alias("label")), "label")


@query("""WITH c AS (SELECT lang AS label, source, count(*) AS n FROM documents GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY label) AS total, row_number() OVER (PARTITION BY label ORDER BY n DESC, source) AS place FROM c)
  SELECT label, source, n, n / total::DOUBLE AS share, n / total::DOUBLE >= 0.6 AS flagged FROM r WHERE place = 1""")
def source_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.source_concentration(table(spark, sf_dir, "documents").select(F.col("lang").alias("label"), "source"), "label", "source")


@query(f"""WITH {ITEMS} SELECT label, count(*) FILTER (WHERE {CATEGORY} = 'small') AS small, count(*) FILTER (WHERE {CATEGORY} = 'medium') AS medium, count(*) FILTER (WHERE {CATEGORY} = 'large') AS large FROM items GROUP BY 1""")
def size_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.crosstab(items(spark, sf_dir).select("label", category().alias("category")), "label", "category", ["small", "medium", "large"])


def _skew_sql(hit: str, times: float, least: float) -> str:
    return f"""WITH {ITEMS}, p AS (SELECT label, count(*) AS n, count(*) FILTER (WHERE {hit}) AS hits FROM items GROUP BY 1), o AS (SELECT *, sum(hits) OVER ()::DOUBLE / sum(n) OVER () AS overall, hits::DOUBLE / n AS share FROM p)
      SELECT label, n, hits, share, overall, overall > 0 AND share > {least} AND share >= {times} * overall AS flagged FROM o"""


@query(_skew_sql("size < 200", 1.5, 0.05))
def size_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.skew(items(spark, sf_dir).select("label", "size"), "label", category() == "small", stats.SMALL_SKEW, stats.SMALL_LEAST)


@query(_skew_sql("toxic = 1", 2.0, 0.02))
def flag_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.skew(items(spark, sf_dir).select("label", "toxic"), "label", F.col("toxic") == 1, stats.FLAG_SKEW, stats.FLAG_LEAST)


@query(f"""WITH {ITEMS}, r AS (SELECT label, {ROLE} AS role FROM items) SELECT label, count(*) AS n, count(*) FILTER (WHERE role IN ('unique', 'canonical')) AS "real",
    count(*) FILTER (WHERE role IN ('augmented', 'augmented_topup')) AS synthetic, count(*) FILTER (WHERE role IN ('unique', 'canonical'))::DOUBLE / count(*) AS real_share FROM r GROUP BY 1""")
def real_vs_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.real_and_synthetic(items(spark, sf_dir).select("label", role().alias("role")), "label", "role")


@query(f"""WITH {ITEMS} SELECT label, category, GROUPING(label, category)::BIGINT AS level, count(*) AS n, count(*) FILTER (WHERE toxic = 1) AS flagged FROM (SELECT label, {CATEGORY} AS category, toxic FROM items) GROUP BY GROUPING SETS ((label), (category))""")
def metadata_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = items(spark, sf_dir).select("label", category().alias("category"), "toxic")
    return i.groupingSets([["label"], ["category"]], "label", "category").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") == 1).alias("flagged"))


@query("""WITH c AS (SELECT lang AS bar, source AS part, count(*) AS n FROM documents GROUP BY 1, 2)
  SELECT bar, part, n, coalesce(sum(n) OVER (PARTITION BY bar ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM c""")
def stacked_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("bar"), F.col("source").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return stats.stacked_base(c, "bar", "part", "n")


@query("SELECT doc_id, lang AS label, dense_rank() OVER (ORDER BY lang) - 1 AS class_index FROM documents")
def class_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return d.join(stats.class_index(d, "label"), "label").select("doc_id", "label", "class_index")


CHECK = """c AS (SELECT d.doc_id, l.toxic = 1 AS old_flag, CASE WHEN d.n_chars % 13 = 0 THEN 'corrupt' ELSE 'ok' END AS status, CASE WHEN d.n_chars % 11 <> 0 THEN d.n_chars % 4 = 0 END AS measured FROM documents d JOIN labels l USING (doc_id)),
  k AS (SELECT doc_id, old_flag, CASE WHEN status <> 'ok' THEN 'skipped_not_ok' WHEN measured IS NULL THEN 'unreadable_at_recheck' WHEN measured THEN 'channel_analysis' ELSE 'not_grayscale' END AS method,
    CASE WHEN status = 'ok' THEN coalesce(measured, old_flag) ELSE old_flag END AS new_flag FROM c)"""


def _rechecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    n = F.col("n_chars")
    c = d.join(lab, "doc_id").select("doc_id", (F.col("toxic") == 1).alias("old_flag"), F.when(n % 13 == 0, "corrupt").otherwise("ok").alias("status"), F.when(n % 11 != 0, n % 4 == 0).alias("measured"))
    return quality.recheck(c, "status", "old_flag", "measured")


@query(f"WITH {CHECK} SELECT doc_id, old_flag, new_flag, method FROM k WHERE old_flag <> new_flag")
def flag_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rechecked(spark, sf_dir).where("old_flag <> new_flag").select("doc_id", "old_flag", "new_flag", "method")


@query(f"WITH {CHECK} SELECT count(*) FILTER (WHERE old_flag) AS old_n, count(*) FILTER (WHERE new_flag) AS new_n, count(*) FILTER (WHERE old_flag <> new_flag) AS corrected, count(*) FILTER (WHERE method = 'unreadable_at_recheck') AS unreadable FROM k")
def flag_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rechecked(spark, sf_dir).agg(F.count_if("old_flag").alias("old_n"), F.count_if("new_flag").alias("new_n"), F.count_if(F.col("old_flag") != F.col("new_flag")).alias("corrected"), F.count_if(F.col("method") == "unreadable_at_recheck").alias("unreadable"))


@query("""WITH c AS (SELECT coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source, count(*) AS n FROM documents GROUP BY 1, 2),
  p AS (SELECT lang, sum(n)::BIGINT AS t, '{' || string_agg('"' || source || '":' || n, ',' ORDER BY source) || '}' AS s FROM c GROUP BY 1)
  SELECT '{"total":' || sum(t)::BIGINT || ',"labels":{' || string_agg('"' || lang || '":' || t, ',' ORDER BY lang) || '},"sources":{' || string_agg('"' || lang || '":' || s, ',' ORDER BY lang) || '}}' AS json FROM p""")
def statistics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics as one JSON document; built from one row a label and source. A null label or source is ``unknown``."""
    d = table(spark, sf_dir, "documents").groupBy(F.coalesce("lang", F.lit("unknown")).alias("lang"), F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    per = d.groupBy("lang").agg(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("sources"))
    return per.agg(F.to_json(F.struct(F.sum("total").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "total")))).alias("labels"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "sources")), lambda a, b: F.when(a["lang"] < b["lang"], -1).when(a["lang"] > b["lang"], 1).otherwise(0))).alias("sources"))).alias("json"))


def _warned_sql(name: str, clear: str) -> str:
    return f"(SELECT coalesce(string_agg('- warning: ' || label, chr(10) ORDER BY label), '- {clear}') FROM ({ORACLES[name]}) WHERE flagged)"


def _tenths_sql(a: str, b: str) -> str:
    t = f"((20 * {a} + {b}) // (2 * {b}))::BIGINT"
    return f"({t} // 10 || '.' || {t} % 10)"


@query(f"""SELECT concat_ws(chr(10), '# Collection health', '', '## Imbalance', '', '- largest: ' || i.largest || ' (' || i.largest_n || ')', '- smallest: ' || i.smallest || ' (' || i.smallest_n || ')', '- ratio: ' || round(i.ratio, 2),
    '', '## Source concentration', '', {_warned_sql('source_concentration', 'no label leans on one source')}, '', '## Skew', '', {_warned_sql('size_skew', 'no label stands out')},
    '', '## Flagged items', '', {_warned_sql('flag_skew', 'no label has many')}, '', '## Composition', '', '- all: ' || c.n, '- mean per label: ' || {_tenths_sql('c.n', 'c.k')}, '- real: ' || c."real" || ' (' || {_tenths_sql('100 * c."real"', 'c.n')} || ' %)',
    '- synthetic: ' || c.synthetic || ' (' || {_tenths_sql('100 * c.synthetic', 'c.n')} || ' %)', '', '## Labels', '', '| label | items | share | real | synthetic |', '|-|-|-|-|-|', t.lines, '') AS report
  FROM ({ORACLES['imbalance']}) i, (SELECT count(*) AS k, sum(n)::BIGINT AS n, sum("real")::BIGINT AS "real", sum(synthetic)::BIGINT AS synthetic FROM ({ORACLES['real_vs_synthetic']})) c,
    (SELECT string_agg('| ' || coalesce(label, 'unknown') || ' | ' || n || ' | ' || {_tenths_sql('100 * n', 'whole')} || ' % | ' || {_tenths_sql('100 * "real"', 'n')} || ' % | ' || {_tenths_sql('100 * synthetic', 'n')} || ' % |', chr(10) ORDER BY coalesce(label, 'unknown')) AS lines
      FROM (SELECT *, (sum(n) OVER ())::BIGINT AS whole FROM ({ORACLES['real_vs_synthetic']}))) t""")
def health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown report, formatted on the driver from frames of one row a label."""
    row = imbalance(spark, sf_dir).first().asDict()
    warned = [sorted(str(r["label"]) for r in q(spark, sf_dir).where("flagged").select("label").collect()) for q in (source_concentration, size_skew, flag_skew)]
    labels = [(r["label"] or "unknown", r["n"], r["real"], r["synthetic"]) for r in real_vs_synthetic(spark, sf_dir).collect()]
    return spark.createDataFrame([(stats.health_report("Collection health", row, *warned, labels),)], "report string")


# -- tables at the edges, lookups ------------------------------------------------------------

EDGES = """SELECT doc_id, 'D:\\set ' || doc_id % 3 || '\\a, "b"\\' || doc_id AS path, CASE doc_id % 3 WHEN 1 THEN 'say "x", \\y' WHEN 2 THEN lang END AS note, n_chars FROM documents"""


@query(EDGES)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas, backslashes and nulls through CSV and back."""
    k = F.col("doc_id")
    path = F.concat(F.lit("D:\\set "), (k % 3).cast("string"), F.lit('\\a, "b"\\'), k.cast("string"))
    d = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), F.when(k % 3 == 1, 'say "x", \\y').when(k % 3 == 2, F.col("lang")).alias("note"), "n_chars")
    where = new_path(spark, "csv")
    files.write_csv(d, where)
    return files.read_csv(spark, where, d.schema)


@query("""WITH seen AS (SELECT doc_id, n_chars AS width, 0 AS turn FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT doc_id, n_chars + 1, 1 FROM documents WHERE doc_id % 10 = 1),
    dims AS (SELECT doc_id, arg_max(width, turn) AS width FROM seen GROUP BY 1), marks AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1)
  SELECT d.doc_id, coalesce(w.width * (d.doc_id % 500), 0)::BIGINT AS area, coalesce('quality ' || m.quality, '') AS provenance FROM documents d LEFT JOIN dims w USING (doc_id) LEFT JOIN marks m USING (doc_id)""")
def attribute_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and provenance looked up by key: the last report counts, a missing one gives an area of 0 or a blank."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    seen = d.where("doc_id % 5 <> 0").select("doc_id", F.col("n_chars").alias("width"), F.lit(0).alias("turn"))
    seen = seen.union(d.where("doc_id % 10 = 1").select("doc_id", F.col("n_chars") + 1, F.lit(1)))
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    both = d.join(reconcile.last_wins(seen, ["doc_id"], "turn"), "doc_id", "left").join(marks, "doc_id", "left")
    area = F.coalesce(F.col("width") * (F.col("doc_id") % 500), F.lit(0)).cast("long")
    return both.select("doc_id", area.alias("area"), F.coalesce(F.concat(F.lit("quality "), F.col("quality").cast("string")), F.lit("")).alias("provenance"))


@query(f"""WITH {STATUS} SELECT doc_id, label, status, CASE WHEN ok THEN n_chars END AS width, CASE WHEN ok THEN doc_id % 500 + 1 END AS height, CASE WHEN ok THEN round(n_chars::DOUBLE / (doc_id % 500 + 1)::DOUBLE, 3) END AS ratio
    FROM (SELECT *, status IN ('ok', 'wrong_format') AS ok FROM checked)""")
def metadata_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of good items; rejected ones stay with blanks."""
    h = F.col("doc_id") % 500 + 1
    rows = _checked(spark, sf_dir).select("doc_id", "label", "status", F.col("n_chars").alias("width"), h.alias("height"), names.aspect_ratio(F.col("n_chars"), h).alias("ratio"))
    return quality.attributes(rows, "status", ["width", "height", "ratio"])


@query(f"""WITH {CHANGES}, q AS (SELECT d.lang AS label, d.doc_id % 7 <> 3 AS moved FROM documents d WHERE doc_id IN (SELECT doc_id FROM changes WHERE change = 'added_discovered_on_disk'))
  SELECT label, GROUPING(label)::BIGINT AS level, count(*) FILTER (WHERE moved) AS moved, count(*) FILTER (WHERE NOT moved) AS missing FROM q GROUP BY ROLLUP (label)""")
def move_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.move_counts(quarantine(spark, sf_dir), ["label"])


@query(f"""WITH {CHECK}, v AS (SELECT 'before' AS version, old_flag AS flag FROM k UNION ALL SELECT 'after', new_flag FROM k)
  SELECT version, count(*) AS n, count(*) FILTER (WHERE flag) AS flagged FROM v GROUP BY 1""")
def rewritten_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corrected table is published as a whole; what it replaces stays and can be read."""
    rows, where = _rechecked(spark, sf_dir), new_path(spark, "flags")
    first = versions.publish(rows.select("doc_id", F.col("old_flag").alias("flag")), where)
    before = versions.read(spark, where)
    versions.publish(before.join(rows.select("doc_id", "new_flag"), "doc_id").select("doc_id", F.col("new_flag").alias("flag")), where, replaces=first)
    both = versions.read(spark, where, first).withColumn("version", F.lit("before")).unionByName(versions.read(spark, where).withColumn("version", F.lit("after")))
    return both.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.count_if("flag").alias("flagged"))


# -- files, types and batches ----------------------------------------------------------------


@query("""SELECT coalesce(source, 'unknown') AS dataset, coalesce(lang, 'unknown') AS folder, count(*) FILTER (WHERE doc_id % 3 <> 2) AS n,
    coalesce(string_agg(DISTINCT CASE doc_id % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.png' END, '|' ORDER BY CASE doc_id % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.png' END), '') AS formats,
    count(*) FILTER (WHERE doc_id % 3 <> 2 AND (doc_id % 5 = 0 OR coalesce(text, '') = '')) AS empty,
    coalesce(sum(octet_length(encode(text))) FILTER (WHERE doc_id % 3 <> 2 AND doc_id % 5 <> 0), 0)::BIGINT AS bytes FROM documents GROUP BY 1, 2""")
def folder_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files laid out by source and label, some of no bytes and some of another kind, and counted by a listing."""
    root, k = new_path(spark, "files"), F.col("doc_id")
    d = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("lang", F.lit("unknown")).alias("lang"), "doc_id", "text")
    name = F.concat(F.lit("doc"), k.cast("string"), F.when(k % 3 == 0, ".JPG").when(k % 3 == 1, ".png").otherwise(".txt"))
    files.write_files(d.select(F.concat_ws("/", F.lit(root), "source", "lang", name).alias("path"), F.when(k % 5 != 0, F.col("text")).alias("content")), "path", "content")
    roots = {r["source"]: f"{root}/{r['source']}" for r in d.select("source").distinct().collect()}
    found = files.list_folders(spark, roots, SUFFIXES)
    kinds = F.array_join(F.array_sort(F.collect_set(names.suffix(F.col("name")))), "|")
    there = F.col("name").isNotNull()
    return found.groupBy("dataset", "folder").agg(F.count("name").alias("n"), kinds.alias("formats"), F.count_if(there & (F.coalesce("size", F.lit(0)) == 0)).alias("empty"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


SHEET = """sheet AS (SELECT doc_id::VARCHAR AS doc_id, CASE WHEN doc_id % 4 = 0 THEN (n_chars // 10)::VARCHAR ELSE (n_chars // 10) || '.25' END AS ratio,
    CASE doc_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' ELSE '' END AS flag, '2024-02-' || lpad((1 + doc_id % 28)::VARCHAR, 2, '0') AS day,
    CASE WHEN doc_id % 50 = 7 THEN 'n/a' ELSE n_chars::VARCHAR END AS mixed, lang, ''::VARCHAR AS nothing FROM documents)"""


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of several types, through CSV."""
    k, n = F.col("doc_id"), F.col("n_chars")
    tens = F.floor(n / 10).cast("string")
    d = table(spark, sf_dir, "documents").select(
        k.cast("string").alias("doc_id"), F.when(k % 4 == 0, tens).otherwise(F.concat(tens, F.lit(".25"))).alias("ratio"), F.when(k % 3 == 0, "True").when(k % 3 == 1, "false").otherwise("").alias("flag"),
        F.concat(F.lit("2024-02-"), F.lpad((1 + k % 28).cast("string"), 2, "0")).alias("day"), F.when(k % 50 == 7, "n/a").otherwise(n.cast("string")).alias("mixed"), "lang", F.lit("").alias("nothing"),
    )
    where = new_path(spark, "sheet")
    files.write_csv(d, where)
    return files.read_csv(spark, where, T.StructType([T.StructField(c, T.StringType()) for c in d.columns]))


@query(f"""WITH {SHEET}, v AS (UNPIVOT (SELECT coalesce(doc_id, '') AS doc_id, coalesce(ratio, '') AS ratio, coalesce(flag, '') AS flag, coalesce(day, '') AS day, coalesce(mixed, '') AS mixed, coalesce(lang, '') AS lang, nothing FROM sheet) ON COLUMNS(*) INTO NAME name VALUE v)
  SELECT name, CASE WHEN count(*) FILTER (WHERE v <> '') = 0 THEN 'string' WHEN bool_and(lower(v) IN ('true', 'false')) FILTER (WHERE v <> '') THEN 'boolean' WHEN bool_and(TRY_CAST(v AS BIGINT) IS NOT NULL AND NOT contains(v, '.')) FILTER (WHERE v <> '') THEN 'long'
      WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) FILTER (WHERE v <> '') THEN 'double' WHEN bool_and(TRY_CAST(v AS DATE) IS NOT NULL) FILTER (WHERE v <> '') THEN 'date' ELSE 'string' END AS type,
    count(*) FILTER (WHERE v <> '') AS filled, count(*) FILTER (WHERE v = '') AS blank FROM v GROUP BY 1""")
def csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.column_types(_sheet(spark, sf_dir))


@query(f"WITH {SHEET} SELECT doc_id::BIGINT AS doc_id, ratio::DOUBLE AS ratio, nullif(flag, '')::BOOLEAN AS flag, dayofyear(day::DATE)::INT AS day, mixed, nullif(lang, '') AS lang, NULL::VARCHAR AS nothing FROM sheet")
def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read without a schema, in the types that its values have."""
    return infer.typed(_sheet(spark, sf_dir)).withColumn("day", F.dayofyear("day"))


@query("""WITH s AS (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL), l AS (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL), c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2)
  SELECT s.source AS dataset, l.lang AS label, CASE WHEN coalesce(c.n, 0) % 7 = 0 THEN 0 ELSE coalesce(c.n, 0) END AS n FROM s CROSS JOIN l LEFT JOIN c ON c.source = s.source AND c.lang = l.lang""")
def sheet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a sheet with lines before its header, a blank column, ragged lines and unreadable cells."""
    c = table(spark, sf_dir, "documents").where("source is not null and lang is not null").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    sources = sorted(r["source"] for r in c.select("source").distinct().collect())
    cell = lambda s: F.when(F.col(s) % 7 == 0, "_").otherwise(F.coalesce(F.col(s).cast("string"), F.lit("")))
    quoted = F.concat(F.lit('"'), F.replace("lang", F.lit('"'), F.lit('""')), F.lit('"'))
    body = c.groupBy("lang").pivot("source", sources).agg(F.first("n")).select(F.lit(2).alias("k"), F.concat_ws(",", F.lit(""), quoted, cell(sources[0]), F.lit("99"), *[cell(s) for s in sources[1:]]).alias("value")) if sources else c.select(F.lit(2), "lang").limit(0)
    first = [(0, "Images per set"), (0, ",,"), (0, "src0,Names,of Breed"), (1, ",".join(["", sheets.MARK, *sources[:1], "  ", *sources[1:]])), (3, ",,5,5"), (3, "")]
    where = new_path(spark, "matrix")
    spark.createDataFrame(first, "k int, value string").union(body).coalesce(1).sortWithinPartitions("k").select("value").write.text(where)
    return sheets.matrix_counts(spark, where).select("dataset", "label", "n")


@query("""WITH f AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), b AS (SELECT doc_id, k, sha256(unhex(substr(h, k * 2000 + 1, 2000))) AS d FROM (SELECT *, unnest(range(greatest(1, (length(h) + 1999) // 2000))) AS k FROM f)),
    p AS (SELECT doc_id, k // 8 AS k, count(*) AS n, sha256(unhex(string_agg(d, '' ORDER BY k))) AS d FROM b GROUP BY 1, k // 8), q AS (SELECT doc_id, k // 8 AS k, sum(n) AS n, sha256(unhex(string_agg(d, '' ORDER BY k))) AS d FROM p GROUP BY 1, k // 8),
    r AS (SELECT doc_id, k // 8 AS k, sum(n) AS n, sha256(unhex(string_agg(d, '' ORDER BY k))) AS d FROM q GROUP BY 1, k // 8)
  SELECT doc_id, w::BIGINT AS blocks, d AS digest FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id, lev) AS w FROM (SELECT *, 0 AS lev FROM p UNION ALL SELECT *, 1 FROM q UNION ALL SELECT *, 2 FROM r)) WHERE lev = CASE WHEN w <= 8 THEN 0 WHEN w <= 64 THEN 1 ELSE 2 END""")
def chunk_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of files that are read by byte ranges, here of small blocks and a small fan."""
    root = new_path(spark, "bytes")
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit(f"{root}/"), (F.col("doc_id") % 13).cast("string"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"), F.coalesce("text", F.lit("")).alias("content"))
    files.write_files(d, "path", "content")
    listed = files.list_folders(spark, {"bytes": root}).where("name is not null").select(F.concat_ws("/", "root", "folder", "name").alias("path"), "size")
    found = chunks.file_digests(cut(listed, "listed"), "path", "size", block=1000, at_once=3, fan=8)
    return found.select(F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), "blocks", "digest")


LINES = """lines AS (SELECT doc_id, n_chars, lang, CASE doc_id % 9 WHEN 0 THEN doc_id || ',' || n_chars WHEN 1 THEN doc_id || ',x' || n_chars || ',a' WHEN 2 THEN doc_id || ',' || n_chars || ',a,b' WHEN 3 THEN doc_id || ',"' || n_chars || ',a'
    WHEN 4 THEN doc_id || ',' || n_chars || ',"a, ""b"" c"' ELSE doc_id || ',' || n_chars || ',' || coalesce(lang, '') END AS line FROM documents)"""


@query(f"""WITH {LINES} SELECT CASE WHEN doc_id % 9 > 3 THEN 'kept' ELSE 'quarantined' END AS state, CASE WHEN doc_id % 9 > 3 THEN doc_id || '|' || n_chars || '|' || CASE WHEN doc_id % 9 = 4 THEN 'a, "b" c' ELSE coalesce(lang, '') END ELSE line END AS line FROM lines""")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that don't fit the schema are kept apart as they stand; nothing fails."""
    k, n = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    nine, c = F.col("doc_id") % 9, lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    good = c(k, ",", n, ",", F.coalesce("lang", F.lit("")))
    line = F.when(nine == 0, c(k, ",", n)).when(nine == 1, c(k, ",x", n, ",a")).when(nine == 2, c(k, ",", n, ",a,b")).when(nine == 3, c(k, ',"', n, ",a")).when(nine == 4, c(k, ",", n, ',"a, ""b"" c"')).otherwise(good)
    where = new_path(spark, "lines")
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(where)
    kept, bad = files.read_csv_apart(spark, where, T.StructType().add("doc_id", "long").add("n_chars", "long").add("note", "string"), header=False)
    kept = kept.select(F.lit("kept").alias("state"), c(F.col("doc_id").cast("string"), "|", F.col("n_chars").cast("string"), "|", F.coalesce("note", F.lit(""))).alias("line"))
    return kept.union(bad.select(F.lit("quarantined"), "line"))


@query("SELECT doc_id, lang, content_hash FROM (SELECT doc_id, lang, sha256(coalesce(text, '')) AS content_hash, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id) AS place FROM documents) WHERE place = 1")
def stream_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that arrive in several batches, the later half of their ids first; the stream is stopped in between and goes on."""
    source, out = new_path(spark, "arrivals"), new_path(spark, "ingested")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for odd in (1, 0):
        d.where(F.pmod("doc_id", F.lit(2)) == odd).repartition(4).write.mode("append").parquet(source)
        arrivals = ingest.stream(spark, source, d.schema, files_per_batch=3)
        ingest.keep_first(arrivals, out, f"{out}/checkpoint", "text", "doc_id").awaitTermination()
    return ingest.first_rows(spark, out, "doc_id").select("doc_id", "lang", "content_hash")


@query("""WITH i AS (SELECT row_number() OVER (ORDER BY lang, doc_id) - 1 AS position, doc_id, lang AS label, dense_rank() OVER (ORDER BY lang) - 1 AS class_index FROM documents WHERE lang IS NOT NULL AND doc_id % 10 < 8)
  SELECT * FROM i WHERE position % 40 = 3""")
def item_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training part's items with their class index, numbered and written, and read back by position."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), F.when(F.col("doc_id") % 10 < 8, "train").otherwise("test").alias("split")).where("label is not null")
    d = access.subset(d, split="Train")
    where = new_path(spark, "items")
    access.write_index(d.join(stats.class_index(d, "label"), "label").select("doc_id", "label", "class_index"), ["label", "doc_id"], where, per_file=1 << 10)
    asked = spark.range(3, d.count(), 40).select(F.col("id").alias("position"))
    return access.items_of(spark, where, asked, "position")


# -- images ----------------------------------------------------------------------------------

PICTURES = """pic AS (SELECT vec_id, CASE WHEN vec_id % 4 = 1 THEN 4 ELSE 8 END AS c, vec_id % 10 NOT IN (3, 7) AS ok, vec_id % 3 = 0 AS mono,
    list_transform(embedding, lambda e: least(255, greatest(0, floor(128 + 240 * e::DOUBLE)))) AS v FROM embeddings WHERE len(embedding) = 64),
  g AS (SELECT vec_id, c, mono, v, CASE WHEN mono THEN v ELSE list_transform(v, lambda x: 0.299 * x + 0.587 * (255 - x) + 0.114 * x) END AS p FROM pic WHERE ok)"""


@F.pandas_udf(T.BinaryType())
def _drawn(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for ids, cells in batches:
        out = []
        for k, v in zip(ids, cells, strict=True):
            plane = np.kron(np.asarray(v, np.uint8).reshape(8, 8), np.ones((4, 4) if k % 4 == 1 else (8, 8), np.uint8))
            data = images.encode_png(plane[..., None] if k % 3 == 0 else np.stack([plane, 255 - plane, plane], axis=-1))
            out.append(b"\xff\xd8\xff" + data if k % 10 == 3 else data[:60] if k % 10 == 7 else data)
        yield pd.Series(out)


def _pictures(spark: SparkSession, sf_dir: str, draw: Callable = _drawn) -> DataFrame:
    """Each vector as an image of 8 x 8 cells, gray or in colour; some are cut off or have another format's first bytes."""
    e = table(spark, sf_dir, "embeddings").where("size(embedding) = 64")
    cells = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(128 + 240 * x.cast("double")))).cast("int"))
    return e.select("vec_id", draw("vec_id", cells).alias("content"))


@query(f"""WITH {PICTURES},
  px AS (SELECT vec_id, c, p, x, y FROM g, range(1, 63) AS a(x), range(1, 63) AS b(y) WHERE x < 8 * c - 1 AND y < 8 * c - 1),
  sharp AS (SELECT vec_id, var_pop(p[(y - 1) // c * 8 + x // c + 1] + p[(y + 1) // c * 8 + x // c + 1] + p[y // c * 8 + (x - 1) // c + 1] + p[y // c * 8 + (x + 1) // c + 1] - 4 * p[y // c * 8 + x // c + 1]) AS s FROM px GROUP BY 1),
  k AS (SELECT u, a, sum(cos(pi() / 64 * (2 * (4 * a + t) + 1) * u)) AS w FROM range(8) AS q(u), range(8) AS r(a), range(4) AS s(t) GROUP BY 1, 2),
  cell AS (SELECT vec_id, f, i // 8 AS y, CASE WHEN f = 1 THEN 7 - i % 8 ELSE i % 8 END AS x, p[i + 1] AS p FROM g, range(64) AS r(i), range(2) AS m(f)),
  low AS (SELECT vec_id, f, ky.u, kx.u AS v, sum(p * ky.w * kx.w) AS low FROM cell JOIN k ky ON ky.a = y JOIN k kx ON kx.a = x GROUP BY ALL),
  bits AS (SELECT vec_id, f, string_agg(CASE WHEN low > med THEN '1' ELSE '0' END, '' ORDER BY u, v) AS b FROM (SELECT *, median(low) OVER (PARTITION BY vec_id, f) AS med FROM low) GROUP BY 1, 2),
  diff AS (SELECT vec_id, CASE WHEN mono THEN 0 ELSE list_avg(list_transform(v, lambda x: abs(2 * x - 255))) * 2 / 3 END AS d FROM g)
  SELECT pic.vec_id, CASE WHEN vec_id % 10 = 3 THEN 'JPEG' ELSE 'PNG' END AS format, vec_id % 10 = 3 AS wrong_format, CASE WHEN ok THEN (8 * c)::INT END AS width, CASE WHEN ok THEN (8 * c)::INT END AS height,
    CASE WHEN ok THEN c = 4 END AS too_small, CASE WHEN ok THEN CASE WHEN mono THEN 'L' ELSE 'RGB' END END AS mode, coalesce(round(s, 6), 0) AS sharpness, round(d, 6) AS channel_diff,
    CASE WHEN ok THEN mono OR d < 8 END AS gray, n.b AS phash, m.b AS phash_flipped
  FROM pic LEFT JOIN sharp USING (vec_id) LEFT JOIN diff USING (vec_id) LEFT JOIN (SELECT vec_id, b FROM bits WHERE f = 0) n USING (vec_id) LEFT JOIN (SELECT vec_id, b FROM bits WHERE f = 1) m USING (vec_id)""")
def image_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats, sizes, flags, sharpness and hashes (as bits) of images that are decoded in tasks."""
    p = _pictures(spark, sf_dir)
    found = images.image_format(F.col("content"))
    rows = p.select("vec_id", found.alias("format"), images.wrong_format(F.lit(".png"), found).alias("wrong_format"), images.facts("content").alias("f")).select("vec_id", "format", "wrong_format", "f.*")
    bits = lambda c: F.lpad(F.bin(c), 64, "0")
    return rows.select(
        "vec_id", "format", "wrong_format", "width", "height", images.too_small(F.col("width"), F.col("height")).alias("too_small"), "mode", F.round("sharpness", 6).alias("sharpness"), F.round("channel_diff", 6).alias("channel_diff"),
        images.is_gray(F.col("mode"), F.col("channel_diff")).alias("gray"), bits("phash").alias("phash"), bits("phash_flipped").alias("phash_flipped"),
    )


#: As PICTURES, with a checkerboard of its own strength and sign in each cell: of two-pixel fields where a cell has 8 x 8, of one-pixel fields where it has 4 x 4.
DETAILED = f"""{PICTURES}, fine AS (SELECT vec_id, c, unnest(range(64)) AS i, unnest(list_transform(range(64), lambda i: greatest(12, least(243, v[i + 1])))) AS x, unnest(list_transform(range(64), lambda i: (vec_id * 7 + i * 3) % 25 - 12)) AS d, mono FROM g),
  f AS (SELECT vec_id, c, i, CASE WHEN mono THEN x ELSE 0.413 * x + 0.587 * (255 - x) END AS p, CASE WHEN mono THEN d ELSE -0.174 * d END AS d FROM fine)"""


@F.pandas_udf(T.BinaryType())
def _drawn_finely(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for ids, cells in batches:
        out = []
        for k, v in zip(ids, cells, strict=True):
            side = 4 if k % 4 == 1 else 8
            sign = 1 - 2 * (np.add.outer(np.arange(side), np.arange(side)) % 2)
            detail = (k * 7 + np.arange(64) * 3) % 25 - 12
            plane = np.kron(np.clip(np.asarray(v, np.int64), 12, 243).reshape(8, 8), np.ones((side, side), np.int64)) + np.kron(detail.reshape(8, 8), sign)
            plane = plane.astype(np.uint8)
            data = images.encode_png(plane[..., None] if k % 3 == 0 else np.stack([plane, 255 - plane, plane], axis=-1))
            out.append(b"\xff\xd8\xff" + data if k % 10 == 3 else data[:60] if k % 10 == 7 else data)
        yield pd.Series(out)


@query(f"""WITH {DETAILED}, pairs AS (SELECT a.vec_id AS vec_a, a.p AS x, a.d AS dx, b.p AS y, b.d AS dy, b.c AS c FROM f a JOIN f b ON b.vec_id = a.vec_id + 1 AND b.i = a.i WHERE a.vec_id % 2 = 0),
  blocks AS (SELECT vec_a, x, y, dx * dx AS vx, dy * dy AS vy, dx * dy AS cov FROM pairs WHERE c = 8 UNION ALL SELECT vec_a, x, y + t * dy, dx * dx, 0, 0 FROM pairs, (VALUES (1), (-1)) AS signs(t) WHERE c = 4),
  s AS (SELECT vec_a, avg((2 * x * y + 6.5025) * (2 * cov + 58.5225) / ((x * x + y * y + 6.5025) * (vx + vy + 58.5225))) AS s FROM blocks GROUP BY 1)
  SELECT a.vec_id AS vec_a, b.vec_id AS vec_b, round(s.s, 6) AS similarity, CASE WHEN s.s IS NULL THEN 'comparison_failed' WHEN s.s >= 0.95 THEN 'high_ssim_match' ELSE 'low_ssim_different' END AS tier
  FROM pic a JOIN pic b ON b.vec_id = a.vec_id + 1 LEFT JOIN s ON s.vec_a = a.vec_id WHERE a.vec_id % 2 = 0""")
def image_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structural similarity of candidate pairs, here of each even id with its successor; variance and covariance count, since blocks have detail."""
    p = _pictures(spark, sf_dir, _drawn_finely)
    b = p.select((F.col("vec_id") - 1).alias("_k"), F.col("vec_id").alias("vec_b"), F.col("content").alias("other"))
    met = p.where("vec_id % 2 = 0").join(b, F.col("vec_id") == F.col("_k"))
    rows = met.select(F.col("vec_id").alias("vec_a"), "vec_b", F.md5("content") == F.md5("other"), images.structural_similarity("content", "other").alias("s")).toDF("vec_a", "vec_b", "same", "s")
    return rows.select("vec_a", "vec_b", F.round("s", 6).alias("similarity"), quality.tier(F.col("same"), F.col("s")).alias("tier"))


# -- splits and clients ----------------------------------------------------------------------

PATHS = """files AS (SELECT doc_id AS ord, 'd' || doc_id % 7 || '/' || CASE WHEN doc_id % 5 = 0 THEN 'img' || doc_id % 60 || '__topup1_' || doc_id WHEN doc_id % 11 = 0 THEN 'img' || doc_id % 60 || '__aug1_' || doc_id
      WHEN doc_id < 60 THEN 'img' || doc_id ELSE 'img' || doc_id % 60 || 'x' || doc_id END || '.png' AS path FROM documents),
  marks AS (SELECT ord, path AS new_path, 'c' || ord % 10 AS cluster_id FROM files WHERE ord % 3 = 0 UNION ALL SELECT ord + 1000000000, path, 'late' || ord % 10 FROM files WHERE ord % 9 = 0 UNION ALL SELECT ord, '', 'blank' FROM files WHERE ord % 8 = 0),
  own AS (SELECT new_path AS path, arg_max(cluster_id, ord) AS own FROM marks WHERE new_path <> '' GROUP BY 1),
  parts AS (SELECT f.path, o.own, split_part(f.path, '/', 1) AS dir, split_part(split_part(f.path, '/', 2), '.', 1) AS stem FROM files f LEFT JOIN own o USING (path)),
  src AS (SELECT t.path, p.path AS source, p.own AS source_own, row_number() OVER (PARTITION BY t.path ORDER BY length(p.stem), p.path) AS place
    FROM parts t JOIN parts p ON t.dir = p.dir AND starts_with(p.stem, split_part(t.stem, '__topup', 1)) WHERE contains(t.stem, '__topup') AND NOT contains(p.stem, '__topup') AND NOT contains(p.stem, '__aug')),
  one AS (SELECT * FROM src WHERE place = 1),
  keyed AS (SELECT p.path, coalesce(p.own, CASE WHEN o.source IS NOT NULL THEN coalesce(o.source_own, 'topup_' || o.source) END,
    CASE WHEN p.path IN (SELECT source FROM one WHERE source_own IS NULL) THEN 'topup_' || p.path END, 'singleton_' || p.path) AS cluster_key FROM parts p LEFT JOIN one o USING (path))"""


@query(f"WITH {PATHS} SELECT path, cluster_key FROM keyed")
def cluster_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("doc_id"), lambda c: c.cast("string")
    root = F.concat(F.lit("img"), s(k % 60))
    name = F.when(k % 5 == 0, F.concat(root, F.lit("__topup1_"), s(k))).when(k % 11 == 0, F.concat(root, F.lit("__aug1_"), s(k))).when(k < 60, F.concat(F.lit("img"), s(k))).otherwise(F.concat(root, F.lit("x"), s(k)))
    files = table(spark, sf_dir, "documents").select(k.alias("ord"), F.concat(F.lit("d"), s(k % 7), F.lit("/"), name, F.lit(".png")).alias("path"))
    o = F.col("ord")
    marks = files.where(o % 3 == 0).select("ord", F.col("path").alias("new_path"), F.concat(F.lit("c"), s(o % 10)).alias("cluster_id"))
    marks = marks.union(files.where(o % 9 == 0).select(o + 1_000_000_000, "path", F.concat(F.lit("late"), s(o % 10)))).union(files.where(o % 8 == 0).select("ord", F.lit(""), F.lit("blank")))
    return split.cluster_map(files, marks, "path", "ord").select("path", "cluster_key")


def _fold_sql(rows: str, strata: str, bins: list[tuple[str, str]], shares: str = "", tag: str = "") -> str:
    """CTEs that replay the fold cluster by cluster: ``dealt`` has a bin for each cluster. ``bins``: name and target; ``shares``: a join that targets need; ``tag``
    ends the CTEs' names, of which one statement may hold two sets."""
    n, s = len(bins), [x.strip() for x in strata.split(",")]
    on = lambda a, b: " AND ".join(f"{a}.{x} IS NOT DISTINCT FROM {b}.{x}" for x in s)
    best = "CASE " + " ".join(f"WHEN {' AND '.join(f'a{i} / t{i} <= a{j} / t{j}' for j in range(n) if j != i)} THEN {i}" for i in range(n)) + " END"
    return f"""cl{tag} AS (SELECT {strata}, cluster_key, count(*) AS size FROM {rows} GROUP BY ALL),
  tot{tag} AS (SELECT {', '.join(f'totals.{x}' for x in s)}, {', '.join(f'{t} AS t{i}' for i, (_, t) in enumerate(bins))} FROM (SELECT {strata}, sum(size)::DOUBLE AS total FROM cl{tag} GROUP BY ALL) AS totals {shares}),
  seq{tag} AS (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY size, md5('42:' || cluster_key), cluster_key) AS k FROM cl{tag}),
  fold{tag} AS (SELECT {', '.join(f'tot{tag}.{x}' for x in s)}, 0::BIGINT AS k, 0::BIGINT AS size, -1 AS bin, {', '.join(f'0::DOUBLE AS a{i}' for i in range(n))} FROM tot{tag}
    UNION ALL SELECT {', '.join(f'p.{x}' for x in s)}, p.k, p.size, p.bin, {', '.join(f'p.a{i} + CASE WHEN p.bin = {i} THEN p.size ELSE 0 END' for i in range(n))} FROM
      (SELECT {', '.join(f'f.{x}' for x in s)}, q.k, q.size, {', '.join(f'f.a{i}' for i in range(n))}, {best} AS bin FROM fold{tag} f JOIN seq{tag} q ON {on('q', 'f')} AND q.k = f.k + 1 JOIN tot{tag} ON {on('tot' + tag, 'f')}) p),
  took{tag} AS (SELECT {strata}, size, bin, count(*) AS c FROM fold{tag} WHERE k > 0 GROUP BY ALL),
  upto{tag} AS (SELECT *, sum(c) OVER (PARTITION BY {strata}, size ORDER BY bin) AS hi FROM took{tag}),
  spot{tag} AS (SELECT *, row_number() OVER (PARTITION BY {strata}, size ORDER BY md5('42:' || cluster_key), cluster_key) AS r FROM cl{tag}),
  dealt{tag} AS (SELECT {', '.join(f'x.{c}' for c in s)}, x.cluster_key, x.size, u.bin FROM spot{tag} x JOIN upto{tag} u ON {on('u', 'x')} AND u.size = x.size AND x.r <= u.hi AND x.r > u.hi - u.c)"""


SPLIT = f"""{CLUSTERS}, rows AS (SELECT c.ord, c.label, coalesce(l.toxic, 0) = 1 AS flag, c.cluster_id AS cluster_key FROM clustered c LEFT JOIN labels l ON l.doc_id = c.ord),
  {_fold_sql('rows', 'label, flag', [(k, f'total * {s}::DOUBLE') for k, s in SPLIT_SHARES])},
  parted AS (SELECT r.ord, r.label, r.flag, r.cluster_key, CASE d.bin WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split
    FROM rows r JOIN dealt d ON d.label IS NOT DISTINCT FROM r.label AND d.flag = r.flag AND d.cluster_key = r.cluster_key)"""
LEAKY = f"""{SPLIT}, leaky AS (SELECT ord, label, cluster_key, CASE WHEN ord % 5 = 0 THEN 'test' ELSE split END AS split FROM parted),
  votes AS (SELECT cluster_key, split, count(*) AS n FROM leaky GROUP BY 1, 2),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_key ORDER BY n DESC, (split = 'train') DESC, split) AS place FROM votes) WHERE place = 1),
  fixed AS (SELECT l.ord, l.label, l.cluster_key, l.split, b.split AS new_split FROM leaky l JOIN best b USING (cluster_key))"""


def _parted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"), "toxic")
    rows = _clustered(spark, sf_dir).join(lab, "ord", "left").select("ord", "label", (F.coalesce("toxic", F.lit(0)) == 1).alias("flag"), F.col("cluster_id").alias("cluster_key"))
    return cut(split.split(rows, ["label", "flag"], "cluster_key", list(SPLIT_SHARES)), "split")


def _leaky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parted(spark, sf_dir).select("ord", "label", "cluster_key", F.when(F.col("ord") % 5 == 0, "test").otherwise(F.col("split")).alias("split"))


@query(f"WITH RECURSIVE {SPLIT} SELECT ord, label, flag, cluster_key, split FROM parted")
def greedy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parted(spark, sf_dir).select("ord", "label", "flag", "cluster_key", "split")


@query(f"WITH RECURSIVE {SPLIT} SELECT label, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test, coalesce(avg(flag::INT) FILTER (WHERE split = 'train'), 0) AS train_flag_share FROM parted GROUP BY 1")
def split_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parted(spark, sf_dir)
    of = lambda s: F.count_if(F.col("split") == s)
    flagged = F.count_if((F.col("split") == "train") & F.col("flag"))
    return p.groupBy("label").agg(of("train").alias("train"), of("val").alias("val"), of("test").alias("test"), F.coalesce(F.try_divide(flagged.cast("double"), of("train").cast("double")), F.lit(0.0)).alias("train_flag_share"))


@query(f"WITH RECURSIVE {LEAKY} SELECT cluster_key, count(DISTINCT split) AS splits, count(*) AS n FROM leaky GROUP BY 1 HAVING count(DISTINCT split) > 1")
def leakage_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.violations(_leaky(spark, sf_dir), "cluster_key")


@query(f"WITH RECURSIVE {LEAKY} SELECT ord, label, cluster_key, split, new_split FROM fixed WHERE split <> new_split")
def leakage_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.repair(_leaky(spark, sf_dir), "cluster_key").where("split <> new_split").select("ord", "label", "cluster_key", "split", "new_split")


@query(f"WITH RECURSIVE {LEAKY} SELECT count(*) AS remaining FROM (SELECT cluster_key FROM fixed GROUP BY 1 HAVING count(DISTINCT new_split) > 1)")
def leakage_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = split.repair(_leaky(spark, sf_dir), "cluster_key")
    return split.violations(fixed, "cluster_key", "new_split").agg(F.count(F.lit(1)).alias("remaining"))


TRAIN = f"""{CLUSTERS}, rows AS (SELECT ord, label, cluster_id AS cluster_key FROM clustered WHERE ord % 10 < 8),
  {_fold_sql('rows', 'label', [(str(i), f'total / {CLIENTS}') for i in range(CLIENTS)])},
  assigned AS (SELECT r.ord, r.label, r.cluster_key, d.bin::INT AS client_id FROM rows r JOIN dealt d ON d.label IS NOT DISTINCT FROM r.label AND d.cluster_key = r.cluster_key)"""


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).where("ord % 10 < 8").select("ord", "label", F.col("cluster_id").alias("cluster_key"))


def _iid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return federate.assign(_train(spark, sf_dir), "label", "cluster_key", lambda c, label, n: federate.iid_targets(c, label, n, CLIENTS))


@query(f"WITH RECURSIVE {TRAIN} SELECT ord, label, cluster_key, client_id FROM assigned")
def iid_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iid(spark, sf_dir).select("ord", "label", "cluster_key", "client_id")


@query(f"WITH RECURSIVE {TRAIN} SELECT client_id, label, GROUPING(client_id, label)::BIGINT AS level, count(*) AS n FROM assigned GROUP BY CUBE (client_id, label)")
def client_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return federate.distribution(_iid(spark, sf_dir), "label")


HANDED = f"""{SPLIT}, train AS (SELECT ord, label, cluster_key FROM parted WHERE split = 'train'),
  {_fold_sql('train', 'label', [(str(i), f'total / {CLIENTS}') for i in range(CLIENTS)], tag='2')},
  handed AS (SELECT r.ord, r.label, r.cluster_key, d.bin::INT AS client_id FROM train r JOIN dealt2 d ON d.label IS NOT DISTINCT FROM r.label AND d.cluster_key = r.cluster_key)"""


@query(f"WITH RECURSIVE {HANDED} SELECT position, ord, label, cluster_key FROM (SELECT row_number() OVER (ORDER BY ord) - 1 AS position, ord, label, cluster_key FROM handed WHERE client_id = 1) WHERE position % 3 = 1")
def client_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A client's items of the training part that the split itself gives, read back by position."""
    train = access.subset(_parted(spark, sf_dir), split="Train").select("ord", "label", "cluster_key")
    handed = federate.assign(train, "label", "cluster_key", lambda c, label, n: federate.iid_targets(c, label, n, CLIENTS))
    mine, where = cut(access.subset(handed, client=1).drop("client_id"), "handed"), new_path(spark, "items")
    access.write_index(mine, ["ord"], where, per_file=1 << 10)
    return access.items_of(spark, where, spark.range(1, mine.count(), 3).select(F.col("id").alias("position")), "position")


def _uniform_sql(key: str) -> str:
    return f"((('0x' || substr(md5('42:' || coalesce(label, '\\N') || ':' || i || ':' || {key}), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


DIRICHLET_CLIENTS = 10
#: Shape 0.5 by way of 1.5: d = 1.5 - 1/3, c = 1 / sqrt(9 d).
DIRICHLET = f"""{CLUSTERS}, rows AS (SELECT ord, label, cluster_id AS cluster_key FROM clustered WHERE ord % 10 < 8),
  ends AS (SELECT label, i FROM (SELECT DISTINCT label FROM rows), range({DIRICHLET_CLIENTS}) AS t(i)), d AS (SELECT 1.5::DOUBLE - 1::DOUBLE / 3 AS d),
  tries AS (SELECT label, i, k, d, sqrt(-2 * ln({_uniform_sql("k || ':r'")})) * cos(2 * pi() * {_uniform_sql("k || ':t'")}) AS z, {_uniform_sql("k || ':u'")} AS u FROM ends, range(1, {federate.TRIES + 1}) AS t(k), d),
  tried AS (SELECT *, root * root * root AS v FROM (SELECT *, 1 + 1 / sqrt(9 * d) * z AS root FROM tries)),
  taken AS (SELECT label, i, arg_min(d * v, k) AS g FROM tried WHERE root > 0 AND ln(u) < 0.5 * z * z + d - d * v + d * ln(greatest(v, 1e-300)) GROUP BY 1, 2),
  drawn AS (SELECT e.label, e.i, round(coalesce(t.g, d) * pow({_uniform_sql("'p'").replace("label", "e.label").replace("|| i ||", "|| e.i ||")}, 2), 9) AS g FROM ends e CROSS JOIN d LEFT JOIN taken t ON t.label IS NOT DISTINCT FROM e.label AND t.i = e.i),
  raised AS (SELECT label, i, greatest(coalesce(g / nullif(sum(g) OVER (PARTITION BY label), 0), 1), 0.02::DOUBLE) AS r FROM drawn),
  shares AS (SELECT label, list(r ORDER BY i) AS r, sum(r) AS whole FROM raised GROUP BY 1),
  {_fold_sql('rows', 'label', [(str(i), f'total * (r[{i + 1}] / whole)') for i in range(DIRICHLET_CLIENTS)], 'JOIN shares ON shares.label IS NOT DISTINCT FROM totals.label')},
  assigned AS (SELECT r.ord, r.label, r.cluster_key, d.bin::INT AS client_id FROM rows r JOIN dealt d ON d.label IS NOT DISTINCT FROM r.label AND d.cluster_key = r.cluster_key)"""


@query(f"WITH RECURSIVE {DIRICHLET} SELECT ord, label, cluster_key, client_id FROM assigned")
def dirichlet_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewed shares, drawn for each label and client from the hash of their names."""
    return federate.assign(_train(spark, sf_dir), "label", "cluster_key", lambda c, label, n: federate.dirichlet_targets(c, label, n, DIRICHLET_CLIENTS)).select("ord", "label", "cluster_key", "client_id")


@query(f"WITH RECURSIVE {TRAIN} SELECT c.client_id::INT AS client_id, count(a.ord) AS copied, count(a.ord) AS found, count(a.ord) AS in_place FROM range({CLIENTS}) AS c(client_id) LEFT JOIN assigned a USING (client_id) GROUP BY 1")
def written_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client folders with counts taken while they were written, beside what a second look at the folders finds."""
    where = new_path(spark, "clients")
    rows = _iid(spark, sf_dir).withColumn("path", F.concat(F.lit("D:\\train\\"), F.col("cluster_key"), F.lit("\\doc"), F.col("ord").cast("string"), F.lit(".png")))
    copied = federate.write_clients(rows, "label", where, CLIENTS, "path")
    there = spark.read.parquet(where).groupBy("client_id")
    mine = F.concat(F.lit("client_"), F.col("client_id"), F.lit("/"), F.coalesce("label", F.lit("unknown")), F.lit("/doc"), F.col("ord"), F.lit(".png"))
    there = there.agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("path") == mine).alias("in_place"))
    return copied.join(there, "client_id", "left").select("client_id", "copied", F.coalesce("found", F.lit(0)).cast("long").alias("found"), F.coalesce("in_place", F.lit(0)).cast("long").alias("in_place"))


@query("""WITH l AS (SELECT 'train/' || lang || '/' || doc_id AS path FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'raw/' || doc_id FROM documents WHERE doc_id % 3 = 1)
  SELECT doc_id, coalesce((SELECT path FROM l WHERE path = 'raw/' || doc_id), (SELECT path FROM l WHERE path = 'train/' || lang || '/' || doc_id), 'path/' || doc_id) AS found FROM documents""")
def path_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = table(spark, sf_dir, "documents").select("doc_id", "lang"), F.col("doc_id").cast("string")
    d = d.select("doc_id", F.concat(F.lit("raw/"), k).alias("a"), F.concat(F.lit("train/"), F.col("lang"), F.lit("/"), k).alias("b"), F.concat(F.lit("path/"), k).alias("c"))
    listing = d.where("doc_id % 3 = 0").select(F.col("b").alias("path")).union(d.where("doc_id % 3 = 1").select("a"))
    return reconcile.first_found(d, listing, ["a", "b", "c"], "path", "found").select("doc_id", "found")
