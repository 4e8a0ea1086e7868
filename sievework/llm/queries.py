"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import centroid_clustering, decontamination, fingerprints, jaccard_join, language_id, license_scan, lm_scoring, mixing, packing, quality_rules, substring_dedup, vector_codes, warc
from sievework.llm.common import table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), n=3, threshold=(90, 100))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    return language_id.identify(docs, keep=["doc_id", "held_out"])


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.train(docs), keep=["doc_id"], inside=True)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("found")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_language_id, op3_lm_scoring, op4_packing, op5_substring_dedup, op6_quality_rules, op7_warc, op8_license_scan, op9_fingerprints, op10_mixing, op11_decontamination, op12_vector_codes, op13_centroid_clustering, pipeline)}

#: Lower case for A-Z alone, and the words of the benchmark scans.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _rounds_sql(rows: str, books: str, rounds: int, width: int) -> str:
    """CTEs of exact clustering: ``rows`` has id, part and v, ``books0`` part, entry and c; ``a`` and a round has part, id, entry and d."""
    far = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT"
    floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
    out = [f"books0 AS MATERIALIZED ({books})"]
    for k in range(rounds + 1):
        out.append(f"a{k} AS MATERIALIZED (SELECT id, part, v, min((d, entry)) AS m FROM (SELECT x.id, part, x.v, b.entry, {far} AS d FROM {rows} x JOIN books{k} b USING (part)) GROUP BY ALL)")
        if k < rounds:
            out.append(f"u{k} AS (SELECT part, m[2] AS entry, i, sum(v[i]) AS s, count(*) AS n FROM a{k}, range(1, {width + 1}) AS t(i) GROUP BY ALL)")
            out.append(f"books{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(n.c, b.c) AS c FROM books{k} b LEFT JOIN (SELECT part, entry, list({floor} ORDER BY i) AS c FROM u{k} GROUP BY 1, 2) n USING (part, entry))")
    return ",\n        ".join(out)


ORACLES = {
    "op11_decontamination": f"""
        WITH b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
        v AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
        h AS (SELECT v.doc_id, v.s, v.n, win.item FROM v JOIN win ON win.n = v.n AND win.g = array_to_string(v.w[v.s : v.s + v.n - 1], ' ')),
        hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM h) GROUP BY 1),
        it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op12_vector_codes": f"""
        WITH e AS MATERIALIZED (SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS k
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS MATERIALIZED (SELECT id, part, v[part * 16 + 1 : part * 16 + 16] AS v FROM e, range(4) AS t(part)),
        {_rounds_sql("x", "SELECT part, k AS entry, v[part * 16 + 1 : part * 16 + 16] AS c FROM e, range(4) AS t(part) WHERE k < 256", 4, 16)},
        c AS (SELECT id AS vec_id, string_agg(lpad(to_hex(m[2]), 2, '0'), '' ORDER BY part) AS code, sum(m[1])::BIGINT AS error FROM a4 GROUP BY 1),
        s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books4)
        SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c JOIN e ON e.id = c.vec_id, s""",
    "op13_centroid_clustering": f"""
        WITH x AS MATERIALIZED (SELECT vec_id AS id, 0 AS part, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k
          FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        {_rounds_sql("x", "SELECT part, k AS entry, v AS c FROM x WHERE k < 16", 3, 64)},
        f AS (SELECT id AS vec_id, m[2] AS cluster, m[1] AS distance FROM a3)
        SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM f JOIN books3 b ON b.entry = f.cluster""",
    "op1_ngram_jaccard": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
        n AS (SELECT doc_id, len(g) AS n FROM s),
        x AS (SELECT doc_id, unnest(g) AS t FROM s),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
        SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.root) AS component_id FROM n JOIN r ON r.node = n.doc_id GROUP BY 1, 2""",
    "op5_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        v AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM w WHERE len(w) >= 35),
        h AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 34], ' ')) AS h FROM v),
        again AS (SELECT h FROM h GROUP BY 1 HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, s + i AS at FROM h JOIN again USING (h), range(35) AS t(i)),
        each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM w),
        kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.at) AS t FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.at = e.at GROUP BY 1),
        lost AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY 1)
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(lost.c, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_mixing": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('42:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS o FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM d GROUP BY 1),
        w AS (SELECT *, [5.0, 2.0, 1.0][k + 1]::DOUBLE AS weight, [1.5, 1.0, 0.5][k + 1]::DOUBLE AS a, [0.5, 1.0, 1.5][k + 1]::DOUBLE AS b, source_size * 2::DOUBLE AS most FROM s),
        c AS (SELECT *, most / weight AS ratio, coalesce(sum(most) OVER up, 0) AS capped, coalesce(sum(weight) OVER up, 0) AS gone, sum(source_size) OVER ()::DOUBLE AS whole, sum(weight) OVER () AS weights
              FROM w WINDOW up AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        v AS (SELECT *, (whole * 1.5::DOUBLE - capped) / (weights - gone) AS lev FROM c),
        t AS (SELECT source, source_size, a, b, least(most, coalesce(max(CASE WHEN lev <= ratio THEN lev END) OVER () * weight, most)) AS target FROM v),
        f AS (SELECT d.*, t.source_size, t.a, t.b, t.target, round(t.target)::BIGINT AS goal,
              coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
        g AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS full_passes FROM f),
        h AS (SELECT *, (full_passes * size + greatest(0, least(size, goal - full_passes * source_size - before)))::BIGINT AS taken FROM g)
        SELECT doc_id, size, source_size, target, taken,
          CASE WHEN taken > 0 THEN CASE WHEN a = b THEN before / goal::DOUBLE ELSE (sqrt(a * a + 2::DOUBLE * (b - a) * (before / goal::DOUBLE * (a + b) / 2)) - a) / (b - a) + 0::DOUBLE END END AS position,
          CASE WHEN taken > size THEN CASE WHEN a = b THEN (before + source_size) / goal::DOUBLE ELSE (sqrt(a * a + 2::DOUBLE * (b - a) * ((before + source_size) / goal::DOUBLE * (a + b) / 2)) - a) / (b - a) + 0::DOUBLE END END AS position_again
        FROM h""",
    "op7_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
        t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND coalesce(page_id < top, top IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND coalesce(page_id < top, top IS NOT NULL) THEN top END AS refers_to
        FROM t""",
}
