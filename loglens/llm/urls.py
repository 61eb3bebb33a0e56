"""URL filters: rules by host and path, and boosted trees on lexical features for what no rule fits.

Rules label the URLs they fit; trees trained on those labels judge the others. Features are the length and the
share of digits and the entropy of a URL, the depth of its path, its number of parameters and hyphens, the number of
labels of its host, and statistics of its suffix (its last label): how often it is labelled, and with what.
Only DataFrame functions and the library's own trees run.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged by the trees
with the features of an empty text. With labels of one kind only, that kind is the verdict; with none, ``allow``.
Repeated rows are judged alike. An empty table gives no rows. Columns other than page_id and url are not looked at.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglens.llm.common import lower_ascii
from loglens.session import Staging, join_checked

# Labelled URLs that the trees are trained on, at most about so many; statistics of suffixes are of all of them.
TRAINING_ROWS = 50_000
TREES = 12
DEPTH = 4
SEED = 17

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
FEATURES = ["n_chars", "depth", "digits", "entropy", "parameters", "hyphens", "labels", "suffix_rate", "suffix_count"]


def rule_table(spark: SparkSession, rules=tuple(RULES)) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def host_of(url: str) -> Column:
    return lower_ascii(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise(""))


def path_of(url: str) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (id, url, host, path) with rule and rule_verdict: of the rules that fit, the longest.

    A URL is looked up under its host and each parent domain; of a third of all URLs under one host, each brings
    its own few lookups, so only the rules' side is ever met by many.
    """
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")
    parents = urls.select("id", "path", F.explode(suffixes).alias("rule_host"))
    fits = join_checked(parents, rules, "rule_host").where(F.startswith("path", "rule_path"))
    name = F.concat("rule_host", "rule_path")
    best = fits.groupBy("id").agg(F.max(F.struct(F.char_length(name).alias("n"), name.alias("rule"), "rule_verdict")).alias("best"))
    return urls.join(best, "id", "left").select(*urls.columns, "best.rule", "best.rule_verdict")


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with lexical features; suffix_rate and suffix_count come from ``with_suffixes``."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.char_length(url), F.lit(1)).cast("double")
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.char_length(url) - F.char_length(F.replace(url, c, F.lit(""))))
    entropy = F.aggregate(F.filter(counts, lambda n: n > 0), F.lit(0.0), lambda a, n: a - n / size * F.log2(n / size))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    features = {"n_chars": size, "depth": F.size(F.array_remove(F.split("path", "/"), "")),
                "digits": F.char_length(F.regexp_replace(url, "[^0-9]", "")) / size, "entropy": entropy,
                "parameters": F.size(F.array_remove(F.split(query, "&"), "")),
                "hyphens": F.char_length(F.regexp_replace(url, "[^-]", "")), "labels": F.size(F.array_remove(F.split("host", "[.]"), ""))}
    return urls.withColumns({k: v.cast("double") for k, v in features.items()}).withColumn("suffix", F.substring_index("host", ".", -1))


def with_suffixes(rows: DataFrame) -> DataFrame:
    """``rows`` with the share of blocked URLs and the number of labelled ones under their suffix, over all rows."""
    blocked = (F.col("rule_verdict") == "block").cast("double")
    stats = rows.where("rule_verdict is not null").groupBy("suffix").agg(
        ((F.sum(blocked) + 1) / (F.count("*") + 2)).alias("suffix_rate"), F.log1p(F.count("*").cast("double")).alias("suffix_count"))
    return join_checked(rows, stats, "suffix", "left").fillna({"suffix_rate": 0.5, "suffix_count": 0.0})


def judge(pages: DataFrame, rules: DataFrame | None = None, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """page_id, host, path, rule and verdict for each of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    staging = Staging(spark)
    rules = rule_table(spark) if rules is None else rules
    urls = pages.select("page_id", F.col("url").cast("string")).withColumn("id", F.monotonically_increasing_id())
    urls = urls.withColumns({"host": F.coalesce(host_of("url"), F.lit("")), "path": F.coalesce(path_of("url"), F.lit(""))})
    rows = staging.table(with_suffixes(staging.table(lexical(with_rules(staging.table(urls, "urls"), rules)), "rows")), "features")
    kinds = {r["rule_verdict"]: r["n"] for r in rows.where("rule_verdict is not null").groupBy("rule_verdict").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        verdict = F.lit(next(iter(kinds), "allow"))
        return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", verdict).alias("verdict"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)
    share = min(1.0, training_rows / sum(kinds.values()))
    chosen = F.pmod(F.xxhash64("id", "url"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)
    labelled = vectors.where(F.col("rule_verdict").isNotNull() & chosen).select(
        "vector", (F.col("rule_verdict") == "block").cast("double").alias("blocked"))
    trees = GBTClassifier(featuresCol="vector", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    judged = trees.fit(labelled).transform(vectors)
    method = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"))
