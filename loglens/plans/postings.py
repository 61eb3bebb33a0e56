"""Optional index: for every word, the lines that hold it.

The table is written in word order, so Parquet statistics let a query read the row groups of its own words
only. It answers the same question as ``plans.occurrence`` without reading the lines.
"""

from collections import Counter

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglens import schema as S
from loglens.functions.predicates import platform_filter, version_filter
from loglens.functions.text import required_matches, snippet_tokens
from loglens.plans.occurrence import fold_charts, no_nodes, version_key
from loglens.session import Staging

NODE_COLUMNS = ("node_name", "major_version", "minor_version", "platform")


def postings(lines: DataFrame) -> DataFrame:
    """One row per line and distinct word."""
    return lines.select(F.explode_outer(F.array_distinct("tokens")).alias("word"),
                        F.xxhash64("relpath").alias("file"), "relpath", "line_no", *NODE_COLUMNS).where(F.col("word").isNotNull())


def node_table(lines: DataFrame) -> DataFrame:
    """Every node with its versions and platforms: what lines without a hit count for."""
    return lines.select(*NODE_COLUMNS).distinct()


def build_index(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write the index below ``path``. The range includes the file, so a word found everywhere is spread
    over as many partitions as it needs."""
    staging, keys = Staging(lines.sparkSession), ["word", "file"]
    try:
        # Ranges are found in one pass and dealt out in another; words are cut before, once.
        lines = lines.select(F.array_distinct("tokens").alias("tokens"), "relpath", "line_no", *NODE_COLUMNS)
        lines = staging.table(lines, "lines")
        rows = postings(lines)
        ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
        (ranged.sortWithinPartitions("word", "file", "line_no").drop("file")
         .write.mode("errorifexists").parquet(f"{path}/postings"))
        node_table(lines).write.mode("errorifexists").parquet(f"{path}/nodes")
    finally:
        staging.drop()


def indexed_occurrences(spark: SparkSession, path: str, text: str, version: str | None = S.ALL_VERSIONS,
                        platform: str | None = S.ALL_PLATFORMS, *, pct: int = S.MATCH_PERCENT,
                        by: str = "major") -> DataFrame:
    """``(chart, label, value)`` as ``occurrences`` gives it, from the index."""
    if not text:
        raise ValueError("log text is required")
    asked = version_filter(version) & platform_filter(platform)
    index = spark.read.parquet(f"{path}/postings").where(asked)
    nodes = spark.read.parquet(f"{path}/nodes").where(asked)
    weights = Counter(snippet_tokens(spark, text))
    n = sum(weights.values())
    need = required_matches(n, pct)
    mine = index.where(F.col("word").isin(list(weights)))
    # At most one row per word of the snippet comes to the driver.
    lines_with = {r["word"]: r["count"] for r in mine.groupBy("word").count().collect()}
    probes, weight = [], 0
    for word in sorted(weights, key=lambda w: (lines_with.get(w, 0), w)):
        if weight > n - need:
            break
        probes.append(word)
        weight += weights[word]
    # Only lines with one of the rarest words can be similar; the postings of common words are cut down
    # to those lines before they are shuffled.
    candidates = index.where(F.col("word").isin(probes)).select("relpath", "line_no").distinct()
    if sum(lines_with.get(w, 0) for w in probes) <= 400_000:
        candidates = F.broadcast(candidates)
    weight_of = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
    hits = (mine.join(candidates, ["relpath", "line_no"], "left_semi")
            .groupBy("relpath", "line_no", *NODE_COLUMNS)
            .agg(F.sum(F.element_at(weight_of, F.col("word")) if weights else F.lit(0)).alias("met"))
            .where(F.col("met") >= need).select(*NODE_COLUMNS))
    cells = (hits.withColumn("hit", F.lit(True)).unionByName(nodes.withColumn("hit", F.lit(False)))
             .groupBy("node_name", version_key(by).alias("version"), "platform")
             .agg(F.bool_or("hit").alias("hit"), F.count_if("hit").alias("docs")))
    return fold_charts(cells, [], F.lit(version == S.ALL_VERSIONS), F.lit(platform == S.ALL_PLATFORMS),
                       no_nodes(spark)).drop("docs")
