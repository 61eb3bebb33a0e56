"""On how many nodes does a similar line occur?

One scan answers everything: lines are reduced map-side to cells ``(node, version, platform)``, and only
cells are shuffled. A hot node, version or platform is therefore one row per task.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loglens import schema as S
from loglens.functions.fields import platform_alias, version_label
from loglens.functions.predicates import platform_filter, version_filter
from loglens.functions.text import required_matches_col, similar_to, tokenize, weighted_hits
from loglens.session import cut, every_salt, is_small, salt_of

# Each broadcast row below also holds the words of one snippet.
BROADCAST_SNIPPETS = 20_000
TEXT_REQUIRED = "log text is required"


def version_key(by: str = "major") -> Column:
    """Label lines are broken down by: the major version alone, or the version as offered for choice."""
    if by == "label":
        return version_label("major_version", "minor_version")
    if by != "major":
        raise ValueError(f"break down by 'major' or 'label', not {by!r}")
    major = F.col("major_version")
    return F.when(major == S.MISSING_VERSION, F.lit(S.UNKNOWN)).otherwise(major.cast("string"))


def filter_lines(lines: DataFrame, version: str | None = S.ALL_VERSIONS,
                 platform: str | None = S.ALL_PLATFORMS, include_unknown: bool = True) -> DataFrame:
    kept = lines.where(version_filter(version) & platform_filter(platform))
    return kept if include_unknown else kept.where(F.col("node_name") != S.MISSING_NODE)


def line_hit(lines: DataFrame, text: str, pct: int = S.MATCH_PERCENT) -> Column:
    """Whether a line is similar to ``text``; reads the stored tokens where there are any."""
    if not text:
        raise ValueError(TEXT_REQUIRED)
    stored = "tokens" if "tokens" in lines.columns else None
    return similar_to(lines.sparkSession, text, pct, tokens=stored)


def fold_charts(cells: DataFrame, keys: list[str], version_chart: Column, platform_chart: Column,
                under: DataFrame, node_cap: int | None = None, bucket_cap: int | None = None,
                hits_only: bool = False) -> DataFrame:
    """Fold cells ``(*keys, node_name, version, platform, hit, docs)`` into ``(*keys, chart, label, value, docs)``.

    ``under`` (``*keys, nodes``) keeps totals of zero in sight. With ``hits_only`` the cells are hits alone
    and ``under`` says how many nodes there are in all.
    """
    def part(name, label, wanted):
        return F.struct(F.lit(name).alias("chart"), label.alias("label"), wanted.alias("wanted"))

    parts = F.array(part(S.CHART_TOTAL, F.lit(""), F.lit(True)),
                    part(S.CHART_VERSION, F.col("version"), version_chart),
                    part(S.CHART_PLATFORM, F.col("platform"), platform_chart))
    counted = (cells.select(*keys, "node_name", "hit", "docs", F.explode(parts).alias("c")).where("c.wanted")
               .groupBy(*keys, "c.chart", "c.label", "node_name")
               .agg(F.bool_or("hit").alias("hit"), F.sum("docs").alias("docs"))
               .groupBy(*keys, "chart", "label")
               .agg((F.lit(0).cast("bigint") if hits_only else F.count(F.lit(1))).alias("nodes"), F.count_if("hit").alias("hits"), F.sum("docs").alias("docs")))
    zero = F.lit(0).cast("bigint")
    counted = (counted.unionByName(under.select(*keys, F.lit(S.CHART_TOTAL).alias("chart"), F.lit("").alias("label"),
                                                "nodes", zero.alias("hits"), zero.alias("docs")))
               .groupBy(*keys, "chart", "label")
               .agg(F.sum("nodes").alias("nodes"), F.sum("hits").alias("hits"), F.sum("docs").alias("docs")))

    def capped(count, cap):
        return count if cap is None else F.least(count, F.lit(cap).cast("bigint"))

    def row(label, value, docs):
        return F.struct(label.alias("label"), value.alias("value"), docs.alias("docs"))

    hits, nodes, docs = capped(F.col("hits"), node_cap), capped(F.col("nodes"), node_cap), F.col("docs")
    is_total = F.col("chart") == S.CHART_TOTAL
    rows = F.when(is_total, F.array(row(F.lit(S.LABEL_OCCURS), hits, docs),
                                    row(F.lit(S.LABEL_ABSENT), nodes - hits, zero))).otherwise(
        F.array(row(F.col("label"), capped(F.col("hits"), bucket_cap), docs)))
    return (counted.where(is_total | (F.col("hits") > 0))
            .select(*keys, "chart", F.explode(rows).alias("r")).select(*keys, "chart", "r.*"))


def no_nodes(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.lit(0).cast("bigint").alias("nodes"))


def occurrences(lines: DataFrame, text: str, version: str | None = S.ALL_VERSIONS,
                platform: str | None = S.ALL_PLATFORMS, *, pct: int = S.MATCH_PERCENT, by: str = "major",
                bucket_cap: int | None = None, node_cap: int | None = None,
                include_unknown: bool = True, with_doc_counts: bool = False) -> DataFrame:
    """``(chart, label, value)``: nodes with and without a similar line, and those with one by version and
    by platform.

    A breakdown is given only when all versions, or all platforms, were asked for. ``bucket_cap=10`` and
    ``node_cap=10000`` give the capped counts of a bucket search; by default counts are whole.
    ``with_doc_counts`` adds the number of similar lines.
    """
    hit = line_hit(lines, text, pct)
    cells = (filter_lines(lines, version, platform, include_unknown)
             .withColumn("hit", hit)
             .groupBy("node_name", version_key(by).alias("version"), "platform")
             .agg(F.bool_or("hit").alias("hit"), F.count_if("hit").alias("docs")))
    rows = fold_charts(cells, [], F.lit(version == S.ALL_VERSIONS), F.lit(platform == S.ALL_PLATFORMS),
                       no_nodes(lines.sparkSession), node_cap, bucket_cap)
    return rows if with_doc_counts else rows.drop("docs")


def as_charts(rows: DataFrame) -> DataFrame:
    """``(title, labels, values)`` per chart, from rows with document counts.

    Labels are ordered like buckets, by documents descending; the total keeps its two labels in order.
    """
    order = (F.when(F.col("label") == S.LABEL_OCCURS, F.lit(0)).when(F.col("label") == S.LABEL_ABSENT, F.lit(1))
             .otherwise(-F.col("docs")).cast("bigint"))
    sorted_rows = F.sort_array(F.collect_list(F.struct(order.alias("o"), "label", "value")))
    return (rows.groupBy("chart").agg(sorted_rows.alias("r"))
            .select(F.col("chart").alias("title"), F.col("r.label").alias("labels"),
                    F.col("r.value").alias("values")))


def has_results(rows: DataFrame) -> DataFrame:
    """One row: whether there is anything to show, that is, whether any node has a similar line."""
    occurs = (F.col("chart") == S.CHART_TOTAL) & (F.col("label") == S.LABEL_OCCURS) & (F.col("value") > 0)
    return rows.agg(F.coalesce(F.bool_or(occurs), F.lit(False)).alias("has_results"))


def node_counts(lines: DataFrame, n: int | None = None) -> DataFrame:
    """Documents per node, those with the most first; the first ``n`` nodes if asked for."""
    counts = lines.groupBy("node_name").agg(F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), "node_name")
    return counts if n is None else counts.limit(n)


def nodes_without_match(lines: DataFrame, text: str, version: str | None = S.ALL_VERSIONS,
                        platform: str | None = S.ALL_PLATFORMS, pct: int = S.MATCH_PERCENT) -> DataFrame:
    """Names of the nodes that have lines but no similar one."""
    hit = line_hit(lines, text, pct)
    return (filter_lines(lines, version, platform).withColumn("hit", hit)
            .groupBy("node_name").agg(F.bool_or("hit").alias("hit"))
            .where(~F.col("hit")).select("node_name"))


def refused_requests(requests: DataFrame) -> DataFrame:
    """``(query_id, reason)`` of requests that ``occurrences`` raises for; ``occurrences_batch`` finds no similar line for them."""
    return requests.where(F.coalesce("log_text", F.lit("")) == "").select("query_id", F.lit(TEXT_REQUIRED).alias("reason"))


# --- many snippets at once ---------------------------------------------------------------------------


def _asked_version(version: Column) -> Column:
    """Version choice as a key; null for a choice that is none, which then matches nothing."""
    numbers = F.regexp_extract(version, r"^(-?\d+\.-?\d+)(?:\.|$)", 1)
    exact = F.transform(F.split(numbers, r"\."), lambda x: x.try_cast("int").cast("string"))
    return (F.when(version.isNull() | version.isin("", S.ALL_VERSIONS), F.lit(S.ALL_VERSIONS))
            .when(version == S.PRE_10, F.lit(S.PRE_10))
            .when(version == S.UNKNOWN, F.lit(f"{S.MISSING_VERSION}.{S.MISSING_VERSION}"))
            .when(numbers != "", F.array_join(exact, ".")))


def _held_versions() -> Column:
    """All version keys a line answers to."""
    major, minor = F.col("major_version"), F.col("minor_version")
    return F.filter(F.array(
        F.lit(S.ALL_VERSIONS), F.concat_ws(".", major.cast("string"), minor.cast("string")),
        F.when((major > 0) & (major < 10), F.lit(S.PRE_10))), lambda v: v.isNotNull())


def _held_platforms() -> Column:
    return F.array(F.lit(S.ALL_PLATFORMS), F.col("platform"))


def snippet_table(requests: DataFrame, pct: int = S.MATCH_PERCENT) -> DataFrame:
    """Per request: its distinct words with their weights, how many must be met, and its filters.

    ``snippet`` is the same for requests that ask the same, so that those are matched once.
    """
    tokens = F.col("tokens")
    words = F.array_sort(F.array_distinct(tokens))
    weights = F.transform(F.col("words"), lambda w: F.size(F.filter(tokens, lambda t: t == w)))
    platform = F.coalesce(platform_alias("platform"), F.lit(S.ALL_PLATFORMS))
    asked = (requests.withColumn("tokens", tokenize("log_text")).withColumn("words", words)
             .select("query_id", "words", weights.alias("counts"), F.size(tokens).alias("n"),
                     required_matches_col(F.size(tokens), pct).alias("need"),
                     _asked_version(F.col("version")).alias("asked_version"), platform.alias("asked_platform"),
                     F.coalesce(F.col("version") == S.ALL_VERSIONS, F.lit(False)).alias("version_chart"),
                     F.coalesce(F.col("platform") == S.ALL_PLATFORMS, F.lit(False)).alias("platform_chart")))
    same = F.sha2(F.to_json(F.struct("words", "counts", "asked_version", "asked_platform",
                                     "version_chart", "platform_chart")), 256)
    return (asked.withColumn("snippet", same)
            .withColumn("weights", F.map_from_arrays("words", "counts")).drop("counts"))


def word_frequencies(lines: DataFrame, words: DataFrame) -> DataFrame:
    """In how many lines each of ``words`` (``word``) occurs. Counted map-side; rows out: at most one per word."""
    words = words.select("word").distinct()
    words = F.broadcast(words) if is_small(words) else words
    return (lines.select(F.explode_outer(F.array_distinct("tokens")).alias("word"))
            .join(words, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("lines")))


def probe_words(snippets: DataFrame, frequencies: DataFrame) -> DataFrame:
    """``(snippet, probes)``: rarest words of each snippet that a similar line cannot all do without.

    A similar line misses tokens of weight at most ``n - need``; of words that together weigh more, it
    holds one. That is exact whatever the frequencies are; they only decide how few lines are looked at.
    """
    weighed = snippets.select("snippet", (F.col("n") - F.col("need")).alias("slack"),
                              F.explode("weights").alias("word", "weight"))
    rarity = F.coalesce("lines", F.lit(0))
    rarest = Window.partitionBy("snippet").orderBy(rarity, -F.char_length("word"), "word")
    before = F.coalesce(F.sum("weight").over(rarest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (weighed.join(frequencies, "word", "left").withColumn("before", before)
            .where(F.col("before") <= F.col("slack"))
            .groupBy("snippet").agg(F.collect_list("word").alias("probes")))


def prepare_snippets(requests: DataFrame, frequencies: DataFrame | Callable[[DataFrame], DataFrame],
                     pct: int = S.MATCH_PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(asked, snippets)``: which snippet each request asks for, and the distinct snippets with probes.

    ``frequencies`` is a table ``(word, lines)``, or makes it from the table of words asked for.
    """
    asked = cut(snippet_table(requests, pct))
    snippets = asked.drop("query_id").dropDuplicates(["snippet"])
    if callable(frequencies):
        frequencies = frequencies(snippets.select(F.explode("words").alias("word")))
    return asked, cut(snippets.join(probe_words(snippets, frequencies), "snippet", "left"))


def match_lines(lines: DataFrame, snippets: DataFrame) -> DataFrame:
    """Every similar (line, snippet) pair once: the line's columns with the snippet's.

    Lines meet snippets (see ``prepare_snippets``) through probe words only, and are then checked in full.
    Snippets are broadcast if they were counted and are few; otherwise both sides are shuffled by probe
    word, salted, as one word may be in very many lines.
    """
    probes = snippets.select("snippet", F.explode("probes").alias("word"))
    # Outer, because an inner explode adds a not-null filter that would cut every line into words twice.
    words = lines.withColumn("word", F.explode_outer(F.array_distinct("tokens")))
    if not is_small(snippets, BROADCAST_SNIPPETS) or not is_small(probes):
        # Only the words that some snippet is looked up by go on, before anything is shuffled.
        known = probes.select("word").distinct()
        words = words.join(F.broadcast(known) if is_small(known) else known, "word", "left_semi")
        met = (words.withColumn("salt", salt_of("message"))
               .join(probes.join(snippets, "snippet").withColumn("salt", every_salt()), ["word", "salt"]))
    else:
        met = words.join(F.broadcast(probes), "word").join(F.broadcast(snippets), "snippet")
    # A line that holds several probe words of a snippet counts for the smallest of them only.
    first = F.array_min(F.array_intersect("probes", "tokens")) == F.col("word")
    weighted = weighted_hits(F.col("tokens"), F.col("words"), F.col("weights")) >= F.col("need")
    plain = F.size(F.array_intersect("words", "tokens")) >= F.col("need")
    enough = F.when(F.size("words") == F.col("n"), plain).otherwise(weighted)
    asked = (F.array_contains(_held_versions(), F.col("asked_version"))
             & F.array_contains(_held_platforms(), F.col("asked_platform")))
    return met.where(first).where(asked & enough)


def occurrences_batch(lines: DataFrame, requests: DataFrame, *, pct: int = S.MATCH_PERCENT,
                      by: str = "major", frequencies: DataFrame | None = None,
                      bucket_cap: int | None = None, node_cap: int | None = None) -> DataFrame:
    """``occurrences`` for a table of requests: ``(query_id, chart, label, value, docs)``."""
    if "tokens" not in lines.columns:
        # Never null, or filters on what is made of it would cut every line into words once more.
        lines = lines.withColumn("tokens", F.coalesce(tokenize("message"), F.array().cast("array<string>")))
    if frequencies is None:
        frequencies = lambda words: word_frequencies(lines, words)
    asked, snippets = prepare_snippets(requests, frequencies, pct)
    cells = (match_lines(lines, snippets)
             .groupBy("snippet", "version_chart", "platform_chart", "node_name",
                      version_key(by).alias("version"), "platform")
             .agg(F.lit(True).alias("hit"), F.count(F.lit(1)).alias("docs")))
    charts = fold_charts(cells, ["snippet"], F.col("version_chart"), F.col("platform_chart"),
                         nodes_under(lines, snippets), node_cap, bucket_cap, hits_only=True)
    return asked.select("query_id", "snippet").join(charts, "snippet").drop("snippet")


def nodes_under(lines: DataFrame, snippets: DataFrame) -> DataFrame:
    """``(snippet, nodes)``: nodes with lines under the filters of each snippet.

    A node answers to few filters, so they are joined by equality, not every node with every request.
    """
    held = (lines.select("node_name", "major_version", "minor_version", "platform").distinct()
            .select("node_name", F.explode(_held_versions()).alias("asked_version"), _held_platforms().alias("p"))
            .select("node_name", "asked_version", F.explode("p").alias("asked_platform")).distinct()
            .groupBy("asked_version", "asked_platform").agg(F.count(F.lit(1)).alias("nodes")))
    return (snippets.join(held, ["asked_version", "asked_platform"], "left")
            .select("snippet", F.coalesce("nodes", F.lit(0)).alias("nodes")))
