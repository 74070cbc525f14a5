"""The registered queries of the ten operators and of the corpus pipeline: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fingerprint, language, licenses, line_dedup, ngram_join, quality, toxicity, warc


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), bpe_path())


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(documents(spark, sf_dir))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_neighbours(documents(spark, sf_dir))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(documents(spark, sf_dir), labels(spark, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.classify(documents(spark, sf_dir), labels(spark, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.audited(pages, warc.decayed(pages))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir), keep=["doc_id"])


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.learn_and_identify(documents(spark, sf_dir))


def _licenses_sql() -> str:
    """The scan by brute force: every phrase at every place, every template against every line."""
    low = lambda c: f"translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({sorted(set(t.split()))!r}, '{label}')" for label, t in licenses.TEMPLATES)
    return f"""
        WITH d AS (SELECT doc_id, {low('text')} AS t, regexp_extract_all({low('text')}, '{word}') AS w FROM documents),
        phrases AS (SELECT * FROM (VALUES {phrases}) p(p, label)), templates AS (SELECT * FROM (VALUES {templates}) t(t, label)),
        b AS (SELECT doc_id, label, unnest(list_filter(range(1, len(w) - len(p) + 2), lambda i: w[i:i + len(p) - 1] = p)) - 1 AS k FROM d, phrases WHERE len(w) >= len(p)),
        base AS (SELECT doc_id, count(*) AS n_base, min(k) AS first_word, max(k) AS last_word, list(DISTINCT label) AS labels FROM b GROUP BY doc_id),
        lines AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{word}')) AS w FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
        hits AS (SELECT doc_id, label, len(list_intersect(w, t))::DOUBLE / len(t) AS c FROM lines, templates WHERE len(list_intersect(w, t)) * 1000 >= {int(licenses.THRESHOLD * 1000)} * len(t)),
        more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(c) AS c FROM hits GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(more.c, 0.0) END::DOUBLE AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_ngram_join": op2_ngram_join,
    "op3_fingerprint": op3_fingerprint,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_licenses": op9_licenses,
    "op10_language": op10_language,
}

#: DuckDB SQL for those that SQL can express.
ORACLE: dict[str, str] = {
    "op2_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, md5_number(g) AS g FROM (
                SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        walk AS (SELECT doc_id AS node, doc_id AS reached FROM n UNION SELECT walk.node, e.y FROM walk JOIN e ON walk.reached = e.x)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(reached) AS c FROM walk GROUP BY node) USING (doc_id)
    """,
    "op9_licenses": _licenses_sql(),
    "op8_warc": r"""
        WITH source AS (SELECT page_id, coalesce(url, '') AS url, html, sha256(coalesce(html, '')) AS d FROM pages),
        both_ AS (
            SELECT 1 AS side, page_id, url, coalesce(html, '') AS body, d FROM source
            UNION ALL SELECT 2, page_id, url, CASE WHEN left(d, 1) = '0' AND html <> '' THEN '#' || substr(html, 2) ELSE coalesce(html, '') END, d FROM source WHERE left(d, 1) <> '1'
            UNION ALL SELECT 2, page_id, url, 'extra' || coalesce(html, ''), '' FROM source WHERE left(d, 1) = '2'
        ), named AS (SELECT *, sha256(concat_ws(' ', coalesce(page_id::VARCHAR, ''), url)) AS h FROM both_),
        laid AS (
            SELECT *, concat_ws(chr(13) || chr(10), 'WARC/1.1', 'WARC-Type: resource', 'WARC-Record-ID: <urn:uuid:' || left(h, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-8' || substr(h, 18, 3) || '-' || substr(h, 21, 12) || '>',
                'WARC-Date: 1970-01-01T00:00:00Z', 'WARC-Target-URI: ' || url, 'Content-Type: text/html', 'Content-Length: ' || strlen(body), '', body, '', '') AS record FROM named
        ), hashed AS (SELECT side, page_id, coalesce(CAST(floor(page_id / 1000) AS BIGINT), -1) AS archive, d, strlen(record) AS size, sha256(record) AS digest FROM laid),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY side, archive ORDER BY page_id, digest) - 1 AS seq, CAST(sum(size) OVER (PARTITION BY side, archive ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end" FROM hashed
        )
        SELECT page_id, archive, 0 AS part, seq, "end" - size AS "begin", "end", digest,
            CASE WHEN side = 2 THEN 'extra' WHEN left(d, 1) = '1' THEN 'missing' WHEN left(d, 1) = '0' AND d <> sha256('') THEN 'changed' ELSE 'intact' END AS kind
        FROM placed WHERE side = 1 OR d = ''
    """,
}
