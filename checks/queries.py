"""One query per operator, over whole check tables, with the SQL that must give the same rows."""

import re
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import trees, views as V
from loglens import schema as S
from loglens.functions import fields as FF, paths as P
from loglens.functions.predicates import in_window, is_log_name
from loglens.functions.text import tokenize
from loglens.operators import ledger as L
from loglens.operators.documents import line_documents
from loglens.operators.order import pending_after, scan_order, scan_ranks as ranked_by_scan
from loglens.operators.relevance import mentions_token, relevant_files
from loglens.operators.scope import resolve_scope, sidecar_fields
from loglens.plans import occurrence as O
from loglens.plans.ingest import ingest, member_stats
from loglens.plans.postings import build_index, indexed_occurrences
from checks.tables import DOC_FILES, doc_files, log_lines, spread, table, tokenized_lines
from loglens.session import Staging
from loglens.sources import tables as TB
from loglens.sources.archives import archive_errors, expand_archives, good_members, member_lines, skip_unpacked
from loglens.sources.bundles import bundle_stream, bundle_tree, file_lines, numbered_lines
from loglens.sources.catalogs import platform_options, version_options
from loglens.sources.listing import existing_paths, list_tree, only_case_files
from loglens.sources.parts import expand_in_parts
from loglens.streaming.occurrences import saved_snippets, stream_occurrences
from loglens.streaming.scopes import stream_scoped_ingest

QUERIES, SQL = {}, {}
TABLES = ("documents", "events", "conversations", "pages", "benchmark")


def plain(view: str) -> str:
    return view.format(**{t: t for t in TABLES})


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def check(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query
    return add


# --- lines and tokens as SQL ---------------------------------------------------------------------------

FILES_SQL = plain(DOC_FILES)
LINES_SQL = f"""
SELECT doc_id, case_num, grid_id, node_name, platform, major_version, minor_version,
  unnest(string_split(text, chr(10))) AS message, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
FROM ({FILES_SQL}) f"""
_WORD = r"(?:_+|[\p{L}\p{M}]+(?:[.:''’·][\p{L}\p{M}]+)*|\p{N}+(?:[.,;''’]\p{N}+)*)+"


def tokens_sql(column: str) -> str:
    apart = rf"regexp_replace({column}, '([\p{{Han}}\p{{Hiragana}}])', ' \1 ', 'g')"
    return (f"list_filter(regexp_extract_all(lower({apart}), '{_WORD}'), "
            rf"lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]'))")


TOKENS_SQL = f"SELECT *, {tokens_sql('message')} AS tokens FROM ({LINES_SQL}) l"
SNIPPET, SNIPPET_WORDS = "and the of with error", ["and", "the", "of", "with", "error"]
RARE, RARE_WORDS = "all rights reserved", ["all", "rights", "reserved"]


def hit_sql(words: list[str]) -> str:
    need = max(1, len(words) * 75 // 100)
    return "(" + " + ".join(f"CAST(list_contains(tokens, '{w}') AS INTEGER)" for w in words) + f") >= {need}"


def hits_sql(words: list[str], where: str = "true") -> str:
    return f"SELECT *, {hit_sql(words)} AS hit FROM ({TOKENS_SQL}) t WHERE {where}"


def total_sql(words: list[str], where: str = "true") -> str:
    return f"""
WITH h AS ({hits_sql(words, where)}),
c AS (SELECT count(DISTINCT node_name) AS nodes, count(DISTINCT CASE WHEN hit THEN node_name END) AS hits FROM h)
SELECT 'Occurances' AS chart, 'Occurs' AS label, CAST(hits AS BIGINT) AS value FROM c
UNION ALL SELECT 'Occurances', 'Does not occur', CAST(nodes - hits AS BIGINT) FROM c"""


MAJOR_SQL = "CASE WHEN major_version = -1 THEN 'Unknown' ELSE CAST(major_version AS VARCHAR) END"
LABEL_SQL = """CASE WHEN major_version = -1 THEN 'Unknown' WHEN major_version > 0 AND major_version < 10 THEN 'Pre-10'
  ELSE CAST(major_version AS VARCHAR) || '.' || CAST(minor_version AS VARCHAR) END"""


def breakdown_sql(chart: str, label: str, words: list[str], where: str = "true", value: str | None = None) -> str:
    value = value or "count(DISTINCT node_name)"
    return f"""SELECT '{chart}' AS chart, {label} AS label, CAST({value} AS BIGINT) AS value
FROM ({hits_sql(words, where)}) h WHERE hit GROUP BY {label}"""


def version_sql(words, where="true", label=MAJOR_SQL, value=None):
    return breakdown_sql("Occurances by Version", label, words, where, value)


def platform_sql(words, where="true", value=None):
    return breakdown_sql("Occurances by Platform", "platform", words, where, value)


def union_sql(*parts: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({p}) p{i}" for i, p in enumerate(parts))


# --- occurrence questions --------------------------------------------------------------------------------


@check(union_sql(total_sql(SNIPPET_WORDS), version_sql(SNIPPET_WORDS), platform_sql(SNIPPET_WORDS)))
def occurrence_report(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), SNIPPET)


@check(total_sql(RARE_WORDS))
def occurrence_total(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), RARE, None, None)


@check(version_sql(RARE_WORDS))
def occurrence_by_version(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), RARE).where(F.col("chart") == S.CHART_VERSION)


@check(platform_sql(RARE_WORDS))
def occurrence_by_platform(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), RARE).where(F.col("chart") == S.CHART_PLATFORM)


@check(union_sql(total_sql(SNIPPET_WORDS), version_sql(SNIPPET_WORDS, label=LABEL_SQL)))
def occurrence_by_label(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), SNIPPET, platform=None, by="label")


_PRE10 = "major_version > 0 AND major_version < 10"


@check(union_sql(total_sql(SNIPPET_WORDS, _PRE10), platform_sql(SNIPPET_WORDS, _PRE10)))
def occurrence_pre10(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), SNIPPET, "Pre-10")


_EXACT = "major_version = 10 AND minor_version = 4"


@check(union_sql(total_sql(SNIPPET_WORDS, _EXACT), platform_sql(SNIPPET_WORDS, _EXACT)))
def occurrence_exact_version(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), SNIPPET, "10.4")


_NOVERSION = "major_version = -1 AND minor_version = -1"


@check(union_sql(total_sql(SNIPPET_WORDS, _NOVERSION), platform_sql(SNIPPET_WORDS, _NOVERSION)))
def occurrence_unknown_version(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), SNIPPET, "Unknown")


@check(union_sql(total_sql(["the", "of"], "platform = 'SGA'"), version_sql(["the", "of"], "platform = 'SGA'")))
def occurrence_platform(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), "the of", platform="StorageGRID appliance")


_CAP = "least(count(DISTINCT node_name), 10)"


@check(union_sql(total_sql(SNIPPET_WORDS), version_sql(SNIPPET_WORDS, value=_CAP), platform_sql(SNIPPET_WORDS, value=_CAP)))
def occurrence_capped(spark, sf_dir):
    return O.occurrences(log_lines(spark, sf_dir), SNIPPET, bucket_cap=S.INNER_BUCKETS, node_cap=S.OUTER_BUCKETS)


@check(f"""SELECT r.chart, r.label, r.value, d.docs FROM ({version_sql(SNIPPET_WORDS)}) r JOIN (
  SELECT {MAJOR_SQL} AS label, CAST(count(*) AS BIGINT) AS docs FROM ({hits_sql(SNIPPET_WORDS)}) h WHERE hit
  GROUP BY 1) d ON r.label = d.label""")
def occurrence_doc_counts(spark, sf_dir):
    rows = O.occurrences(log_lines(spark, sf_dir), SNIPPET, with_doc_counts=True)
    return rows.where(F.col("chart") == S.CHART_VERSION)


@check(f"""SELECT 'Occurances' AS title, 'Occurs,Does not occur' AS labels,
  string_agg(CAST(value AS VARCHAR), ',' ORDER BY label DESC) AS "values" FROM ({total_sql(SNIPPET_WORDS)}) t
UNION ALL SELECT title, string_agg(label, ',' ORDER BY docs DESC, label),
  string_agg(CAST(value AS VARCHAR), ',' ORDER BY docs DESC, label) FROM (
    SELECT 'Occurances by Version' AS title, {MAJOR_SQL} AS label, count(DISTINCT node_name) AS value, count(*) AS docs
      FROM ({hits_sql(SNIPPET_WORDS)}) h WHERE hit GROUP BY 2
    UNION ALL SELECT 'Occurances by Platform', platform, count(DISTINCT node_name), count(*)
      FROM ({hits_sql(SNIPPET_WORDS)}) h WHERE hit GROUP BY 2) b GROUP BY title""")
def charts(spark, sf_dir):
    made = O.as_charts(O.occurrences(log_lines(spark, sf_dir), SNIPPET, with_doc_counts=True))
    return made.select("title", F.array_join("labels", ",").alias("labels"), F.array_join(
        F.transform("values", lambda v: v.cast("string")), ",").alias("values"))


@check(f"SELECT bool_or(hit) AS has_results FROM ({hits_sql(RARE_WORDS)}) h")
def results_to_show(spark, sf_dir):
    return O.has_results(O.occurrences(log_lines(spark, sf_dir), RARE))


@check(f"""SELECT node_name FROM ({hits_sql(SNIPPET_WORDS)}) h GROUP BY node_name HAVING NOT bool_or(hit)""")
def nodes_without_match(spark, sf_dir):
    return O.nodes_without_match(log_lines(spark, sf_dir), SNIPPET)


@check(f"""SELECT node_name, CAST(count(*) AS BIGINT) AS docs FROM ({LINES_SQL}) l GROUP BY 1
ORDER BY docs DESC, node_name LIMIT 25""")
def node_counts_topn(spark, sf_dir):
    return O.node_counts(log_lines(spark, sf_dir), 25)


_BATCH_SQL = f"""
WITH t AS ({TOKENS_SQL}),
r AS (SELECT *, {tokens_sql('log_text')} AS words FROM ({plain(V.REQUESTS)}) q),
w AS (SELECT query_id, version, CASE WHEN platform = 'StorageGRID appliance' THEN 'SGA' ELSE platform END AS platform,
  greatest(1, len(words) * 75 // 100) AS need, words FROM r),
qw AS (SELECT query_id, word, count(*) AS weight FROM (SELECT query_id, unnest(words) AS word FROM w) x GROUP BY ALL),
lw AS (SELECT doc_id, line_no, unnest(list_distinct(tokens)) AS word FROM t),
met AS (SELECT query_id, doc_id, line_no, sum(weight) AS met FROM lw JOIN qw USING (word) GROUP BY ALL),
n AS (SELECT doc_id, node_name, platform, major_version, minor_version FROM ({FILES_SQL}) f),
hit AS (SELECT w.query_id, w.version, w.platform AS asked, n.* FROM met JOIN w USING (query_id) JOIN n USING (doc_id)
  WHERE met.met >= w.need),
ok AS (SELECT * FROM hit WHERE (version = 'All Versions' OR (version = 'Pre-10' AND major_version > 0 AND major_version < 10)
    OR (version = 'Unknown' AND major_version = -1) OR version = CAST(major_version AS VARCHAR) || '.' || CAST(minor_version AS VARCHAR))
  AND (asked = 'All Platforms' OR asked = platform)),"""
_BATCH_ALL = "(SELECT w.query_id, w.version, w.platform AS asked, n.* FROM w, n)"


@check(f"""
{_BATCH_SQL}
hits AS (SELECT query_id, count(DISTINCT node_name) AS hits, count(*) AS docs FROM ok GROUP BY 1),
everything AS (SELECT * FROM {_BATCH_ALL} z WHERE (version = 'All Versions' OR (version = 'Pre-10' AND major_version > 0 AND major_version < 10)
    OR (version = 'Unknown' AND major_version = -1) OR version = CAST(major_version AS VARCHAR) || '.' || CAST(minor_version AS VARCHAR))
  AND (asked = 'All Platforms' OR asked = platform)),
nodes AS (SELECT query_id, count(DISTINCT node_name) AS nodes FROM everything GROUP BY 1),
both_ AS (SELECT w.query_id, coalesce(hits, 0) AS hits, coalesce(docs, 0) AS docs, coalesce(nodes, 0) AS nodes
  FROM w LEFT JOIN hits USING (query_id) LEFT JOIN nodes USING (query_id))
SELECT query_id, 'Occurances' AS chart, 'Occurs' AS label, CAST(hits AS BIGINT) AS value, CAST(docs AS BIGINT) AS docs FROM both_
UNION ALL SELECT query_id, 'Occurances', 'Does not occur', CAST(nodes - hits AS BIGINT), CAST(0 AS BIGINT) FROM both_
UNION ALL SELECT query_id, 'Occurances by Version', {MAJOR_SQL}, CAST(count(DISTINCT node_name) AS BIGINT), CAST(count(*) AS BIGINT)
  FROM ok WHERE version = 'All Versions' GROUP BY 1, 3
UNION ALL SELECT query_id, 'Occurances by Platform', platform, CAST(count(DISTINCT node_name) AS BIGINT), CAST(count(*) AS BIGINT)
  FROM ok WHERE asked = 'All Platforms' GROUP BY 1, 3""")
def occurrence_batch(spark, sf_dir):
    return O.occurrences_batch(log_lines(spark, sf_dir), view(spark, sf_dir, V.REQUESTS))


@check(union_sql(total_sql(SNIPPET_WORDS), version_sql(SNIPPET_WORDS), platform_sql(SNIPPET_WORDS)))
def occurrence_indexed(spark, sf_dir):
    lines = tokenized_lines(spark, sf_dir).withColumn("relpath", F.col("doc_id").cast("string"))
    path = f"{Staging(spark).path}/index"
    build_index(lines, path)
    return indexed_occurrences(spark, path, SNIPPET)


# --- text and stored lines ---------------------------------------------------------------------------------


@check(f"""SELECT token, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest({tokens_sql('message')}) AS token FROM (
    SELECT unnest(string_split(text, chr(10))) AS message FROM conversations) m) t GROUP BY token""")
def token_counts(spark, sf_dir):
    talk = spread(table(spark, sf_dir, "conversations"), spark, sf_dir, "conversations")
    lines = talk.select(F.explode(F.split("text", "\n", -1)).alias("message"))
    return (lines.select(F.explode_outer(tokenize("message")).alias("token")).where(F.col("token").isNotNull())
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


@check(f"""SELECT case_num || '/' || grid_id || '/' || CAST(doc_id AS VARCHAR) || '.log/' || CAST(line_no AS VARCHAR) AS doc_id,
  case_num AS "case", node_name, grid_id, platform, major_version, minor_version, CAST(line_no AS BIGINT) AS line_no, message,
  CAST(len(tokens) AS BIGINT) AS n_tokens, CAST(0 AS BIGINT) AS sent_ms FROM ({TOKENS_SQL}) t""")
def documents_of_lines(spark, sf_dir):
    relpath = F.concat_ws("/", "case_num", "grid_id", F.concat(F.col("doc_id").cast("string"), F.lit(".log")))
    lines = log_lines(spark, sf_dir).select(relpath.alias("relpath"), "line_no", "message")
    files = doc_files(spark, sf_dir).select(
        relpath.alias("relpath"), F.col("case_num").alias("case"), "node_name", "grid_id", "platform", "major_version",
        "minor_version", F.lit(S.MISSING_TIME_SPAN).alias("time_span"), F.lit(S.MISSING_CATEGORY).alias("category"))
    return line_documents(lines, files, millis=0).select(
        "doc_id", "case", "node_name", "grid_id", "platform", "major_version", "minor_version", "line_no", "message",
        F.size("tokens").cast("bigint").alias("n_tokens"), F.unix_millis("categorize_time").alias("sent_ms"))


@check(f"""SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, message FROM ({LINES_SQL}) l WHERE node_name = 'src3-n5'
ORDER BY doc_id, line_no LIMIT 10""")
def find_lines(spark, sf_dir):
    found = TB.find_lines(log_lines(spark, sf_dir), "node_name", "src3-n5", limit=S.PAGE_SIZE, order=("doc_id", "line_no"))
    return found.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "message")


@check(f"SELECT CAST(count(*) AS BIGINT) AS docs FROM ({LINES_SQL}) l")
def table_stats(spark, sf_dir):
    return TB.table_stats(log_lines(spark, sf_dir))


@check(f"""SELECT {LABEL_SQL} AS label, CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT node_name) AS BIGINT) AS nodes
FROM ({LINES_SQL}) l GROUP BY 1""")
def version_labels(spark, sf_dir):
    cells = log_lines(spark, sf_dir).groupBy(FF.version_label("major_version", "minor_version").alias("label"),
                                             "node_name").agg(F.count(F.lit(1)).alias("lines"))
    return cells.groupBy("label").agg(F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("nodes"))


@check(f"""SELECT o.platform, CAST(count(n.doc_id) AS BIGINT) AS files FROM (VALUES ('vSphere', 'vSphere'), ('Container', 'Container'),
  ('StorageGRID appliance', 'SGA'), ('Unknown', 'Unknown')) o(platform, stored)
LEFT JOIN ({FILES_SQL}) n ON n.platform = o.stored GROUP BY 1""")
def platform_choices(spark, sf_dir):
    held = doc_files(spark, sf_dir).groupBy(F.col("platform").alias("stored")).agg(F.count(F.lit(1)).alias("files"))
    choices = platform_options(spark).withColumn("stored", FF.platform_alias("platform"))
    return choices.join(held, "stored", "left").select("platform", F.coalesce("files", F.lit(0)).alias("files"))


@check(f"""SELECT o.version, CAST(count(n.doc_id) AS BIGINT) AS files FROM (VALUES ('Pre-10'), ('10.0'), ('10.1'), ('10.2'), ('10.3'),
  ('10.4'), ('11.0'), ('11.1'), ('11.2'), ('11.3'), ('11.4'), ('Unknown')) o(version)
LEFT JOIN ({FILES_SQL}) n ON {LABEL_SQL} = o.version GROUP BY 1""")
def version_choices(spark, sf_dir):
    label = FF.version_label("major_version", "minor_version").alias("version")
    held = doc_files(spark, sf_dir).groupBy(label).agg(F.count(F.lit(1)).alias("files"))
    return version_options(spark).join(held, "version", "left").select(
        "version", F.coalesce("files", F.lit(0)).alias("files"))


# --- paths ----------------------------------------------------------------------------------------------------


@check(f"""
WITH p AS (SELECT page_id, path, list_last(string_split(path, '/')) AS base FROM ({plain(V.PAGE_PATHS)}) q),
e AS (SELECT *, CASE WHEN contains(ltrim(base, '.'), '.') THEN '.' || list_last(string_split(base, '.')) ELSE '' END AS ext FROM p)
SELECT page_id, rtrim(path, '/') AS trimmed, rtrim(left(path, length(path) - length(base)), '/') AS dir, base,
  left(base, length(base) - length(ext)) AS stem, ext, CASE WHEN path LIKE '%/' THEN path || 'x' ELSE path || '/x' END AS joined
FROM e""")
def path_parts(spark, sf_dir):
    return view(spark, sf_dir, V.PAGE_PATHS).select(
        "page_id", P.trim_path("path").alias("trimmed"), P.dir_name("path").alias("dir"), P.base_name("path").alias("base"),
        P.file_stem("path").alias("stem"), P.file_ext("path").alias("ext"), P.join_path("path", F.lit("x")).alias("joined"))


@check(f"""SELECT page_id, CASE WHEN page_id % 7 = 0 THEN path ELSE regexp_replace(path, '\\.(gz|tgz|tar|zip|7z)$', '') END AS one,
  CASE WHEN page_id % 7 = 0 THEN path ELSE regexp_replace(path, '(\\.(gz|tgz|tar|zip|7z))+$', '') END AS every,
  page_id % 7 <> 0 AND regexp_matches(path, '\\.(gz|tgz|tar|zip|7z)$') AS archive FROM ({plain(V.ARCHIVE_NAMES)}) a""")
def strip_archive(spark, sf_dir):
    return view(spark, sf_dir, V.ARCHIVE_NAMES).select(
        "page_id", P.strip_archive_ext("path").alias("one"), P.strip_all_archive_exts("path").alias("every"),
        P.is_archive("path").alias("archive"))


@check(f"""SELECT page_id, rtrim(left(path, length(path) - length('/./a/../b//c/..')), '/') || '/b' AS path
FROM ({plain(V.DIRTY_PATHS)}) d""")
def normalize_paths(spark, sf_dir):
    return view(spark, sf_dir, V.DIRTY_PATHS).select("page_id", P.normalize_path("path").alias("path"))


_CATEGORY_VALUES = ", ".join(f"({i}, '{n}', '{p}')" for i, (n, p) in enumerate(S.CATEGORY_PATTERNS.items()))


@check(f"""
WITH p AS (SELECT doc_id, path, string_split(path, '/') AS parts FROM ({plain(V.LOG_PATHS)}) q),
s AS (SELECT doc_id, unnest(range(1, len(parts))) AS k, parts FROM p),
m AS (SELECT doc_id, arg_min(name, k * 100 + ord) AS name FROM s JOIN (VALUES {_CATEGORY_VALUES}) c(ord, name, pattern)
  ON regexp_matches(array_to_string(list_slice(parts, len(parts) - k + 1, len(parts)), '/'), pattern) GROUP BY doc_id)
SELECT p.doc_id, p.path, coalesce(m.name, 'other') AS category FROM p LEFT JOIN m ON p.doc_id = m.doc_id""")
def category_of_paths(spark, sf_dir):
    return view(spark, sf_dir, V.LOG_PATHS).select("doc_id", "path", FF.category_of("path").alias("category"))


@check(f"""SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'Unknown' ELSE split_part(case_dir, '/', 2) END AS case_number,
  CASE WHEN doc_id % 4 IN (0, 2) THEN split_part(abs_dir, '/', 5) ELSE 'Unknown-Unknown' END AS time_span,
  split_part(abs_dir, '/', 4) AS node_name, split_part(abs_dir, '/', 3) AS grid_id FROM ({plain(V.BUNDLE_DIRS)}) b""")
def case_and_span(spark, sf_dir):
    return view(spark, sf_dir, V.BUNDLE_DIRS).select(
        "doc_id", FF.case_number("case_dir").alias("case_number"), FF.time_span("abs_dir").alias("time_span"),
        FF.node_name("abs_dir").alias("node_name"), FF.grid_id("abs_dir").alias("grid_id"))


# --- sidecars, scopes, relevance ---------------------------------------------------------------------------------


def _sidecar(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.concat_ws("/", "dir", F.lit(name)).alias("relpath"), F.lit(0).cast("bigint").alias("block"),
                     F.col("event_id").alias("mid"), F.col("line").alias("value"))


@check(f"""
WITH f AS (SELECT dir, arg_min(line, event_id) FILTER (contains(line, 'storage-grid-release-')) AS line
  FROM ({plain(V.VERSION_LINES)}) v GROUP BY dir),
x AS (SELECT dir, string_split(line, 'storage-grid-release-') AS around FROM f),
n AS (SELECT dir, CASE WHEN len(around) = 2 THEN string_split(around[2], '.') END AS parts FROM x),
v AS (SELECT dir, TRY_CAST(trim(parts[1]) AS INTEGER) AS major, TRY_CAST(trim(parts[2]) AS INTEGER) AS minor FROM n)
SELECT dir, coalesce(CASE WHEN minor IS NOT NULL THEN major END, -1) AS major_version,
  coalesce(CASE WHEN major IS NOT NULL THEN minor END, -1) AS minor_version FROM v""")
def release_version(spark, sf_dir):
    found = sidecar_fields(_sidecar(view(spark, sf_dir, V.VERSION_LINES), S.VERSION_SIDECAR))
    return found.select("dir", *[F.coalesce(c, F.lit(S.MISSING_VERSION)).alias(c) for c in ("major_version", "minor_version")])


@check(f"""SELECT dir, coalesce(arg_min(CASE WHEN event_id % 11 = 0 THEN 'SGA' ELSE 'vSphere' END, event_id)
  FILTER (event_id % 11 < 2), 'Unknown') AS platform FROM ({plain(V.PLATFORM_LINES)}) v GROUP BY dir""")
def platform_from_sidecar(spark, sf_dir):
    found = sidecar_fields(_sidecar(view(spark, sf_dir, V.PLATFORM_LINES), S.PLATFORM_SIDECAR))
    return found.select("dir", F.coalesce("platform", F.lit(S.MISSING_PLATFORM)).alias("platform"))


def _nearest_sql(name: str, missing: str) -> str:
    return f"coalesce(arg_max(s.{name}, s.depth) FILTER (s.{name} <> {missing}), {missing}) AS {name}"


_VERSION_GIVEN = "FILTER (s.major_version <> -1 OR s.minor_version <> -1)"


@check(f"""SELECT d.dir, {_nearest_sql('node_name', "'Unknown'")}, {_nearest_sql('grid_id', "'Unknown'")},
  {_nearest_sql('time_span', "'Unknown-Unknown'")}, {_nearest_sql('category', "'other'")}, {_nearest_sql('platform', "'Unknown'")},
  coalesce(arg_max(s.major_version, s.depth) {_VERSION_GIVEN}, -1) AS major_version,
  coalesce(arg_max(s.minor_version, s.depth) {_VERSION_GIVEN}, -1) AS minor_version
FROM ({plain(V.TREE_DIRS)}) d LEFT JOIN ({plain(V.TREE_SCOPES)}) s ON starts_with(d.dir || '/', s.dir || '/') GROUP BY d.dir""")
def scope_resolution(spark, sf_dir):
    return resolve_scope(view(spark, sf_dir, V.TREE_DIRS), view(spark, sf_dir, V.TREE_SCOPES))


_NAME_OK = "(relpath LIKE '%.log' OR relpath LIKE '%.txt' OR relpath LIKE '%/syslog.1')"


def _named(spark, sf_dir):
    files = view(spark, sf_dir, V.NAMED_FILES)
    lines = files.select("relpath", F.explode(F.split("text", "\n", -1)).alias("message"))
    return files.drop("text"), lines


@check(f"""SELECT doc_id, relpath, node_name FROM ({plain(V.NAMED_FILES)}) f
WHERE {_NAME_OK} AND (node_name <> 'Unknown' OR contains(relpath, 'bycast') OR contains(text, 'bycast'))""")
def relevant(spark, sf_dir):
    return relevant_files(*_named(spark, sf_dir))


@check(f"""SELECT doc_id, relpath FROM ({plain(V.NAMED_FILES)}) f WHERE contains(relpath, 'bycast') OR contains(text, 'bycast')""")
def token_mentions(spark, sf_dir):
    return mentions_token(*_named(spark, sf_dir)).select("doc_id", "relpath")


@check(f"""
WITH u AS (SELECT relpath AS path FROM ({plain(V.UNPACKED)}) x UNION SELECT regexp_replace(relpath, '/x/y.log$', '') FROM ({plain(V.UNPACKED)}) y)
SELECT relpath FROM ({plain(V.ARCHIVES)}) a
WHERE regexp_replace(relpath, '\\.(zip|tar\\.gz|gz)$', '') NOT IN (SELECT path FROM u)""")
def unpacked_skipped(spark, sf_dir):
    return skip_unpacked(view(spark, sf_dir, V.ARCHIVES), existing_paths(view(spark, sf_dir, V.UNPACKED)))


@check(f"""SELECT relpath AS path FROM ({plain(V.LOG_PATHS.replace(' AS path FROM', ' AS relpath FROM'))}) p
UNION SELECT array_to_string(list_slice(parts, 1, k), '/') FROM (
  SELECT parts, unnest(range(1, len(parts))) AS k FROM (
    SELECT string_split(path, '/') AS parts FROM ({plain(V.LOG_PATHS)}) q) r) s""")
def paths_in_tree(spark, sf_dir):
    return existing_paths(view(spark, sf_dir, V.LOG_PATHS).withColumnRenamed("path", "relpath"))


# --- windows, ledger, order ------------------------------------------------------------------------------------------

_FROM, _TO = 1704153600, 1704240000


@check(f"""SELECT relpath, mtime FROM ({plain(V.EVENT_FILES)}) f
WHERE floor(epoch(mtime)) >= {_FROM} AND floor(epoch(mtime)) < {_TO}""")
def window_filter(spark, sf_dir):
    return view(spark, sf_dir, V.EVENT_FILES).where(in_window(_FROM, _TO)).select("relpath", "mtime")


@check(f"""
WITH r AS (SELECT * FROM ({plain(V.SCAN_RECORDS)}) s ORDER BY seq DESC LIMIT 1)
SELECT CASE WHEN last_path = '' THEN least(stop, 49999) ELSE start END AS start,
  CASE WHEN last_path = '' THEN CAST(50000 AS BIGINT) ELSE stop END AS stop, last_path FROM r""")
def next_window(spark, sf_dir):
    return L.next_window(view(spark, sf_dir, V.SCAN_RECORDS), 50000)


@check(f"SELECT * FROM ({plain(V.SCAN_RECORDS)}) s ORDER BY seq DESC LIMIT 1")
def last_scan_record(spark, sf_dir):
    return L.last_record(view(spark, sf_dir, V.SCAN_RECORDS))


@check(f"SELECT relpath, mtime, event_id FROM ({plain(V.EVENT_FILES)}) f WHERE event_id % 3 <> 0")
def pending_files(spark, sf_dir):
    files = view(spark, sf_dir, V.EVENT_FILES)
    return L.pending(files, files.where(F.col("event_id") % 3 == 0)).select("relpath", "mtime", "event_id")


@check(f"""
WITH r AS (SELECT event_id, value, event_id % 7 > 2 AS good FROM ({plain(V.LEDGER_LINES)}) l),
e AS (SELECT r.*, e.event_type FROM r JOIN events e USING (event_id))
SELECT event_id, good AS valid, CASE WHEN good THEN event_id END AS start, CASE WHEN good THEN event_id + 5 END AS stop,
  CASE WHEN good THEN '/my logs/' || event_type END AS input_dir,
  CASE WHEN good THEN CASE event_id % 2 WHEN 0 THEN '' ELSE 'host/a.log' END END AS last_path,
  CASE WHEN good THEN event_id % 2 = 0 END AS complete, CASE WHEN good THEN value END AS rendered FROM e""")
def ledger_roundtrip(spark, sf_dir):
    parsed = L.parse_ledger(view(spark, sf_dir, V.LEDGER_LINES))
    return parsed.select("event_id", "valid", "start", "stop", "input_dir", "last_path",
                         L.is_complete().alias("complete"), F.when(F.col("valid"), L.render_ledger()).alias("rendered"))


@check(f"SELECT DISTINCT path AS relpath FROM ({plain(V.PAGE_PATHS)}) p")
def files_in_scan_order(spark, sf_dir):
    paths = view(spark, sf_dir, V.PAGE_PATHS).select(F.col("path").alias("relpath")).distinct()
    return scan_order(paths)


@check(f"""SELECT relpath, row_number() OVER (ORDER BY relpath || '/' DESC) AS rank FROM (
  SELECT DISTINCT path AS relpath FROM ({plain(V.PAGE_PATHS)}) p) x""")
def scan_ranks(spark, sf_dir):
    """The place of every path in scan order."""
    paths = view(spark, sf_dir, V.PAGE_PATHS).select(F.col("path").alias("relpath")).distinct()
    return ranked_by_scan(paths, Staging(spark))


def _case_of(records: str) -> str:
    return f"""WITH r AS (SELECT * FROM ({plain(V.SCAN_RECORDS)}) s WHERE {records} ORDER BY seq DESC LIMIT 1)
SELECT CASE WHEN last_path = '' THEN least(stop, SAFE - 1) ELSE start END AS start,
  CASE WHEN last_path = '' THEN CAST(SAFE AS BIGINT) ELSE stop END AS stop, last_path FROM r"""


# What the ledger ends with, which records it holds then, and up to when it is safe to scan (the time less the lag).
_LEDGERS = [("no record", "seq < 0", 1000 - 360), ("complete", "last_path = ''", 10 ** 9 - 360), ("complete, stop is not safe yet", "last_path = ''", 200 - 360),
            ("incomplete", "last_path <> ''", 10 ** 9 - 360), ("incomplete, stop is not safe yet", "last_path <> ''", 200 - 360)]


@check(f"""SELECT 'no record' AS ledger, CAST({S.FIRST_WINDOW_START} AS BIGINT) AS start, CAST(640 AS BIGINT) AS stop, '' AS last_path
""" + "".join(f"UNION ALL SELECT '{name}', * FROM ({_case_of(records).replace('SAFE', str(safe))})\n" for name, records, safe in _LEDGERS[1:]))
def next_windows(spark, sf_dir):
    """The next window after every kind of ledger, some minutes back from now."""
    records = view(spark, sf_dir, V.SCAN_RECORDS)
    windows = [L.next_window(records.where(which), F.lit(safe + S.SAFETY_LAG_S) - S.SAFETY_LAG_S).withColumn("ledger", F.lit(name))
               for name, which, safe in _LEDGERS]
    return reduce(DataFrame.unionByName, windows).select("ledger", "start", "stop", "last_path")


_TOPS = """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '2000000001/a/b.log' WHEN 1 THEN '12345/a.log' WHEN 2 THEN 'x2000000001/a.log'
  WHEN 3 THEN '20000000012/a.log' ELSE '2000000001' END AS relpath FROM {documents}"""


@check(f"SELECT * FROM ({_TOPS.format(documents='documents')}) t WHERE doc_id % 5 = 0")
def case_directories(spark, sf_dir):
    """Files that lie in a directory named by ten digits."""
    return only_case_files(view(spark, sf_dir, _TOPS))


_ASKED = """SELECT conv_id * 1000 + turn AS query_id, CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 5 = 1 THEN NULL ELSE text END AS log_text
FROM {conversations}"""


@check(f"SELECT query_id, 'log text is required' AS reason FROM ({_ASKED.format(conversations='conversations')}) a WHERE coalesce(log_text, '') = ''")
def snippet_required(spark, sf_dir):
    """Requests that can't be answered for want of a snippet."""
    return O.refused_requests(view(spark, sf_dir, _ASKED))


_CURSOR = "/m.thermint.example.net/en"


@check(f"SELECT page_id, path AS relpath FROM ({plain(V.PAGE_PATHS)}) p WHERE path || '/' < '{_CURSOR}/'")
def resume_after(spark, sf_dir):
    paths = view(spark, sf_dir, V.PAGE_PATHS).select("page_id", F.col("path").alias("relpath"))
    return pending_after(paths, _CURSOR)


# --- stored versions of files and lines --------------------------------------------------------------------------------


@check(f"""SELECT doc_id, arg_max(event_id, categorize_time) AS event_id, max(categorize_time) AS categorize_time,
  arg_max(message, categorize_time) AS message FROM ({plain(V.EVENT_DOCUMENTS)}) d GROUP BY doc_id""")
def latest_lines(spark, sf_dir):
    return TB.latest_documents(view(spark, sf_dir, V.EVENT_DOCUMENTS))


@check(f"""SELECT relpath, batch FROM (SELECT *, row_number() OVER (PARTITION BY relpath ORDER BY categorize_time DESC, batch DESC) AS rn
  FROM ({plain(V.EVENT_REPORT)}) r) x WHERE rn > 1""")
def superseded_ingests(spark, sf_dir):
    return TB.superseded_files(view(spark, sf_dir, V.EVENT_REPORT))


@check(f"""SELECT CAST(doc_id AS VARCHAR) AS relpath, CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines,
  CAST(length(text) - length(replace(text, chr(10), '')) + 1 + CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS BIGINT) AS expected,
  doc_id % 9 <> 0 AS ok FROM ({FILES_SQL}) f""")
def report_of_ingest(spark, sf_dir):
    files = doc_files(spark, sf_dir)
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    expected = (newlines + 1 + F.when(F.col("doc_id") % 9 == 0, 1).otherwise(0)).cast("bigint")
    wanted = files.select(F.col("doc_id").cast("string").alias("relpath"), F.col("case_num").alias("case"),
                          F.current_timestamp().alias("categorize_time"), expected.alias("expected"))
    lines = log_lines(spark, sf_dir).select(F.col("doc_id").cast("string").alias("relpath"))
    return TB.ingest_report(lines, wanted).select("relpath", "lines", "expected", "ok")


# --- archives, trees, streams --------------------------------------------------------------------------------------------

_KEPT_LINES = ("len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END "
               "- CASE WHEN text = '' THEN 1 ELSE 0 END")
_A = "'a' || CAST(doc_id AS VARCHAR)"


def _member_sql(kind: int, archive: str, member: str) -> str:
    return f"""SELECT {_A} || '{archive}' AS archive, {_A} || '{member}' AS relpath, CAST(strlen(text) AS BIGINT) AS bytes,
  CAST({_KEPT_LINES} AS BIGINT) AS lines FROM documents WHERE doc_id % 6 = {kind}"""


_PACKED = [_member_sql(0, ".log.gz", ".log"), _member_sql(1, ".tar", "/d/x.log"), _member_sql(1, ".tar", "/n/inner.txt"),
           _member_sql(2, ".tgz", "/x.log"), _member_sql(3, ".zip", "/one.log"), _member_sql(3, ".zip", "/sub/two.log"),
           _member_sql(4, ".log.zip", ".log")]


@check(union_sql(*_PACKED))
def archive_members(spark, sf_dir):
    packed = trees.stored(spark, trees.packed_documents(spark, sf_dir))
    return _members_of(expand_in_parts(packed, Staging(spark)))


def _members_of(expanded: DataFrame) -> DataFrame:
    members = good_members(expanded)
    sizes = members.groupBy("archive", "relpath").agg(F.sum(F.octet_length("content")).alias("bytes"))
    lines = member_lines(members, "archive").groupBy("archive", "relpath").agg(F.count(F.lit(1)).alias("lines"))
    return sizes.join(lines, ["archive", "relpath"], "left").select(
        "archive", "relpath", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"))


@check(f"SELECT {_A} || '.zip' AS archive, 'BadZipFile' AS error FROM documents WHERE doc_id % 6 = 5")
def unreadable_archives(spark, sf_dir):
    packed = trees.stored(spark, trees.packed_documents(spark, sf_dir))
    errors = archive_errors(expand_in_parts(packed, Staging(spark)))
    return errors.select("archive", F.substring_index("error", ":", 1).alias("error"))


def _member_times_sql(sql: str) -> str:
    return re.sub(r"CAST\(strlen.*?AS lines", "doc_id AS seconds", sql, flags=re.S)


@check(union_sql(*map(_member_times_sql, _PACKED)))
def member_times(spark, sf_dir):
    """Members carry the time of the outermost archive."""
    made = F.timestamp_seconds(F.regexp_extract("relpath", r"^a(\d+)", 1).cast("bigint"))
    members = good_members(expand_archives(trees.packed_documents(spark, sf_dir).withColumn("mtime", made)))
    return members.groupBy("archive", "relpath").agg(F.max(F.unix_seconds("mtime")).alias("seconds"))


def _member_letters_sql(sql: str) -> str:
    return re.sub(r"CAST\(strlen.*?AS lines", "CAST(strlen(text) - strlen(replace(text, 'e', '')) AS BIGINT) AS letters", sql, flags=re.S)


@check(union_sql(*map(_member_letters_sql, _PACKED)))
def member_callback(spark, sf_dir):
    """A function of the caller's that every member goes through."""
    def letters(members: DataFrame) -> DataFrame:
        text = F.col("content").cast("string")
        return members.groupBy("archive", "relpath").agg(F.sum(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("e"), F.lit("")))).cast("bigint").alias("letters"))
    return good_members(expand_archives(trees.packed_documents(spark, sf_dir))).transform(letters)


_BUNDLE = "'b' || CAST(doc_id // 64 AS VARCHAR)"
_BUNDLE_EXT = "CASE (doc_id // 64) % 3 WHEN 2 THEN '.tar' ELSE '.zip' END"


@check(f"""SELECT {_BUNDLE} || {_BUNDLE_EXT} AS archive, {_BUNDLE} || '/logs/' || CAST(doc_id AS VARCHAR) || '.log' AS relpath,
  CAST(strlen(text) AS BIGINT) AS bytes, CAST({_KEPT_LINES} AS BIGINT) AS lines FROM documents
UNION ALL SELECT {_BUNDLE} || {_BUNDLE_EXT}, {_BUNDLE} || '/bin/' || CAST(doc_id AS VARCHAR) || '.dat', 0, 0 FROM documents""")
def members_in_parts(spark, sf_dir):
    """Members of larger archives, each read from its place; of those that are no logs only the name is left."""
    packed = trees.bundled_documents(spark, sf_dir)
    return _members_of(expand_in_parts(packed, Staging(spark), is_log_name(), task_bytes=4 << 20, range_bytes=16 << 10))


@check(f"""SELECT CAST(doc_id AS VARCHAR) || '.log' AS relpath, CAST(CASE WHEN doc_id % 3 = 0 THEN len(string_split(text, chr(10)))
  ELSE {_KEPT_LINES} END AS BIGINT) AS kept FROM documents""")
def utf8_cut(spark, sf_dir):
    members = good_members(expand_archives(trees.spoiled_documents(spark, sf_dir)))
    return member_stats(members).select("relpath", F.col("expected").alias("kept"))


@check(f"""SELECT relpath, CAST(strlen(text) AS BIGINT) AS length, CAST({_KEPT_LINES} AS BIGINT) AS lines, CAST(1 AS BIGINT) AS listed,
  CAST({_KEPT_LINES} AS BIGINT) AS streamed_lines FROM ({trees.ODD_NAMES.format(documents="documents")}) f""")
def listed_files(spark, sf_dir):
    """Files with hidden, codec-like, deep, odd and empty names: as a table with its lines, and as a stream with its lines."""
    root, cores = trees.odd_tree(spark, sf_dir), spark.sparkContext.defaultParallelism
    files = Staging(spark).table(bundle_tree(spark, root).where("NOT is_dir"), "files")
    lines = numbered_lines(file_lines(files, range_bytes=8 << 10, tasks=4 * cores)).groupBy("relpath").agg(F.max("line_no").alias("lines"))
    seen, out = root.removesuffix("/in") + "/seen", root.removesuffix("/in") + "/out"
    stream = file_lines(bundle_stream(spark, root, lag_s=-3600), range_bytes=8 << 10, tasks=4 * cores)
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", seen).trigger(availableNow=True).start()
     .awaitTermination())
    streamed = spark.read.schema(stream.schema).parquet(out).groupBy("relpath").agg(F.count(F.lit(1)).alias("streamed_lines"))
    listed = files.groupBy("relpath", "length").agg(F.count(F.lit(1)).alias("listed"))
    return (listed.join(lines, "relpath", "left").join(streamed, "relpath", "left")
            .select("relpath", "length", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "listed", "streamed_lines")]))


_BODY = "CASE WHEN text LIKE '%' || chr(10) THEN left(text, length(text) - 1) ELSE text END"


@check(f"""SELECT relpath, CAST(line_no AS BIGINT) AS line_no, line AS value FROM (
  SELECT relpath, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS line_no
  FROM (SELECT relpath, {_BODY} AS body FROM ({trees.ODD_NAMES.format(documents="documents")}) f WHERE text <> '') b) l""")
def split_lines(spark, sf_dir):
    """Every line of files that are read in ranges of a few kilobytes, with its number."""
    files = bundle_tree(spark, trees.odd_tree(spark, sf_dir)).where("NOT is_dir")
    lines = file_lines(files, range_bytes=4 << 10, tasks=4 * spark.sparkContext.defaultParallelism)
    return numbered_lines(Staging(spark).table(lines, "lines"))


@check("SELECT CAST(count(*) AS BIGINT) AS docs, true AS bytes_of_files FROM events")
def stored_size(spark, sf_dir):
    """Documents of a stored table, and whether its bytes are those of its data files."""
    where = f"{Staging(spark).path}/events"
    table(spark, sf_dir, "events").write.parquet(where)
    stored = list_tree(spark, where).where("relpath LIKE '%.parquet' AND NOT startswith(relpath, '.')").agg(F.sum("length").alias("stored"))
    stats = TB.table_stats(spark.read.parquet(where), where)
    return stats.join(stored).select("docs", (F.col("bytes") == F.col("stored")).alias("bytes_of_files"))


_TREE_SQL = f"""
WITH f AS (SELECT d.lang, v.* FROM ({FILES_SQL}) v JOIN documents d USING (doc_id)),
l AS (SELECT *, CASE WHEN text LIKE '%' || chr(10) THEN left(text, length(text) - 1) ELSE text END AS body FROM f),
k AS (SELECT doc_id, case_num, lang, grid_id, node_name, major_version, minor_version, platform,
  unnest(string_split(body, chr(10))) AS message FROM l WHERE text <> '' AND (node_name <> 'Unknown' OR doc_id % 2 = 1
    OR contains(text, 'bycast')))
SELECT case_num AS "case", node_name, CASE WHEN node_name = 'Unknown' THEN 'Unknown' ELSE grid_id || '-' || lang END AS grid_id,
  CASE WHEN node_name = 'Unknown' THEN -1 ELSE major_version END AS major_version,
  CASE WHEN node_name = 'Unknown' THEN -1 ELSE minor_version END AS minor_version,
  CASE WHEN node_name = 'Unknown' THEN 'Unknown' ELSE platform END AS platform,
  CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT doc_id) AS BIGINT) AS files, CAST(sum(length(message)) AS BIGINT) AS chars
FROM k GROUP BY ALL"""


def _tree_files(spark, sf_dir):
    files = doc_files(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return files.select("doc_id", "case_num", "grid_id", "node_name", "lang", "text")


def _tree(spark, sf_dir):
    return trees.write_tree(spark, _tree_files(spark, sf_dir))


def _tree_summary(lines: DataFrame) -> DataFrame:
    keys = ["case", "node_name", "grid_id", "major_version", "minor_version", "platform"]
    base = P.base_name("relpath")
    return (lines.where(~base.isin(S.MARKER_FILE, S.VERSION_SIDECAR))
            .groupBy(*keys, "relpath").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("message")).alias("chars"))
            .groupBy(*keys).agg(F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("files"), F.sum("chars").alias("chars")))


@check(_TREE_SQL)
def ingest_tree(spark, sf_dir):
    root = _tree(spark, sf_dir)
    store = root.removesuffix("/in") + "/store"
    ingest(spark, root, store, lag_s=-3600, cases_per_batch=25)
    return _tree_summary(TB.LogTable(spark, store).current_lines())


@check(_TREE_SQL)
def interrupted_ingest(spark, sf_dir):
    """Ingest that is stopped after every few cases, and taken up again until its window is done."""
    root = _tree(spark, sf_dir)
    store, runs = root.removesuffix("/in") + "/store", []
    while not runs or not runs[-1].complete:
        left = iter([False, True])
        runs.append(ingest(spark, root, store, lag_s=-3600, cases_per_batch=18, should_stop=lambda: next(left)))
    if len({(r.start, r.stop) for r in runs}) != 1 or len(runs) != 4:
        raise ValueError(f"the window of an interrupted ingest should stay: {runs}")
    return _tree_summary(TB.LogTable(spark, store).current_lines())


@check(_TREE_SQL)
def ingest_stream(spark, sf_dir):
    """The tree as it comes in: first logs and archives, then version sidecars, then markers and platform sidecars."""
    files, base = Staging(spark).table(trees.tree_files(spark, _tree_files(spark, sf_dir)), "files"), P.base_name("relpath")
    root = trees.written(spark, files.where(~base.isin(S.MARKER_FILE, S.VERSION_SIDECAR, "user_data")))
    store, seen = root.removesuffix("/in") + "/store", root.removesuffix("/in") + "/seen"
    for part in ((), (S.VERSION_SIDECAR,), (S.MARKER_FILE, "user_data")):
        if part:
            trees.written(spark, files.where(base.isin(*part)), root)
        time.sleep(1.5)                                     # a window ends at the last full second
        stream_scoped_ingest(spark, root, store, seen, lag_s=0).awaitTermination()
    return _tree_summary(TB.LogTable(spark, store).current_lines())


def _stream(spark, sf_dir, name):
    """A check table as a stream, be it one file or a directory of files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    return reader.parquet(path.toString()) if whole else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


_STREAMED = f"""SELECT item_id AS query_id, CASE item_id % 4 WHEN 0 THEN text WHEN 1 THEN 'all rights reserved'
  WHEN 2 THEN 'and the of with error' ELSE 'worthless of and the' END AS log_text, 'All Versions' AS version,
  'All Platforms' AS platform FROM {{benchmark}}"""


@check(f"""
WITH t AS ({TOKENS_SQL}), w AS (SELECT query_id, {tokens_sql('log_text')} AS words FROM ({plain(_STREAMED)}) q),
qw AS (SELECT query_id, word, count(*) AS weight FROM (SELECT query_id, unnest(words) AS word FROM w) x GROUP BY ALL),
lw AS (SELECT doc_id, line_no, node_name, unnest(list_distinct(tokens)) AS word FROM t),
met AS (SELECT query_id, doc_id, line_no, node_name, sum(weight) AS met FROM lw JOIN qw USING (word) GROUP BY ALL)
SELECT query_id, CAST(count(DISTINCT node_name) AS BIGINT) AS nodes FROM met JOIN w USING (query_id)
WHERE met.met >= greatest(1, len(words) * 75 // 100) GROUP BY query_id""")
def occurrence_stream(spark, sf_dir):
    documents = spread(_stream(spark, sf_dir, "documents"), spark, sf_dir, "documents")
    lines = spark.sql(DOC_FILES.format(documents="{documents}"), documents=documents).select(
        "node_name", "platform", "major_version", "minor_version", F.explode(F.split("text", "\n", -1)).alias("message"))
    counts = stream_occurrences(lines, saved_snippets(view(spark, sf_dir, _STREAMED)))
    where = Staging(spark).path

    def keep(df, _):
        df.write.mode("overwrite").parquet(f"{where}/nodes")

    (counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{where}/seen")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(counts.schema).parquet(f"{where}/nodes")
