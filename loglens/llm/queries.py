"""One query per operator, each over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglens.llm import (alignment, decontaminate, embeddup, fingerprints, langid, lexical, licenses, neardup, packing, pii, quality,
                         secret_scan, urls)
from loglens.llm.common import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents"))


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents and of their edited texts."""
    return fingerprints.fingerprint(read(spark, sf_dir, "documents"))


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are similar."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in documents."""
    return pii.personal_data(read(spark, sf_dir, "documents"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in ten-word windows of benchmark items."""
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of documents, their own or that of a directory above."""
    return licenses.scan_documents(read(spark, sf_dir, "documents"))


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the URL of every page."""
    return urls.judge(read(spark, sf_dir, "pages"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of documents, learned from two thirds of them."""
    return langid.identify(read(spark, sf_dir, "documents"))


@query
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in documents."""
    return secret_scan.scan(read(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of documents under a model of the trusted ones, and which of them to keep."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers over all documents."""
    return alignment.align(read(spark, sf_dir, "documents"))


@query
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return lexical.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of embeddings of equal label that point nearly the same way."""
    return embeddup.near_vectors(read(spark, sf_dir, "embeddings"))


_WORDS = r"""list_filter(string_split_regex(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

SQL["op5_benchmark_decontamination"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS words
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0)),
starts AS (
    SELECT doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, s, n FROM starts JOIN windows USING (n, words)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_PII_KINDS = [                              # kind, plain pattern, check of a match f, score, context, least score
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 70, "mail|contact|write to|reach", 0),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "len(list_filter(string_split(f, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(ltrim(p, '0') AS INT), 0) > 255)) = 0",
     50, r"\bip\b|address|server|host", 0),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     "length(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: "
     "CAST(d[length(d) - i + 1] AS INT) * (2 - i % 2) - CASE WHEN CAST(d[length(d) - i + 1] AS INT) * (2 - i % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0",
     65, "card|visa|credit|payment", 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15", 50, "phone|call|mobile|fax", 0),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b",
     "length(replace(f, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_transform(string_split(replace(f, ' ', '')[5:] || f[1:4], ''), "
     "lambda c: instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1), lambda a, v: (CASE WHEN v > 9 THEN a * 100 + v ELSE a * 10 + v END) % 97) = 1",
     65, "iban|account|bank", 60),
    ("idnum", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "true", 35, r"\bssn\b|social security|identity", 60),
]


def _pii_sql() -> str:
    found = " UNION ALL ".join(f"""
        SELECT doc_id, {k} AS k, '{name}' AS kind, s, e, score FROM (
            SELECT doc_id, s, s + length(f) AS e, {score} + CASE WHEN regexp_matches(
                substring(t, greatest(s - 40, 0) + 1, least(s, 40)), '(?i){context}') THEN 30 ELSE 0 END AS score
            FROM (SELECT doc_id, t, f, regexp_replace(f, '[^0-9]', '', 'g') AS d,
                         CAST(list_sum(list_transform(g[1:i + 1], lambda y: length(y))) AS BIGINT)
                         + coalesce(CAST(list_sum(list_transform(m[1:i], lambda y: length(y))) AS BIGINT), 0) AS s
                  FROM (SELECT doc_id, t, m, g, i, m[i + 1] AS f
                        FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM texts),
                             unnest(range(len(m))) AS places(i)))
            WHERE {check}) WHERE score >= {least}""" for k, (name, pattern, check, score, context, least) in enumerate(_PII_KINDS))
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s)"
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({found}),
    per_doc AS (SELECT doc_id, {counts}, {listed} FILTER (k < 4) AS base, {listed} AS spans,
                       string_agg(CAST(score AS VARCHAR), ',' ORDER BY k, s) AS scores FROM found GROUP BY doc_id)
    SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
           coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
           coalesce(scores, '') AS scores
    FROM texts LEFT JOIN per_doc USING (doc_id)"""


SQL["op4_pii"] = _pii_sql()


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL["op12_ranked_lexical_search"] = rf"""
WITH d AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, t FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) SEMI JOIN i USING (term) GROUP BY doc_id, n, term),
size AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM p, size GROUP BY term, docs),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
           FROM i JOIN p USING (term) JOIN w USING (term), size GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

SQL["op13_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT vec_id, b FROM reached JOIN links ON other = a),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)
"""
