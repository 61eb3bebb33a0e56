"""From documents to packed sequences: quality, near-duplicates, contamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglens.llm import decontaminate, neardup, packing, quality, secret_scan
from loglens.llm.common import read
from loglens.session import Staging


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return quality.filter_quality(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return neardup.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by markers and n_chars brought up to date."""
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequences and places."""
    return packing.pack_documents(docs)


STAGES = [("quality_classifier", quality_classifier), ("near_dedup", near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("secret_scans", secret_scans),
          ("best_fit_packing", best_fit_packing)]

#: A language model and minhashes are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written and read again in the shared folder."""
    staging = Staging(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return docs
