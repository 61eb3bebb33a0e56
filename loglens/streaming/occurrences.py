"""Continuous occurrence counts for saved snippets."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglens import schema as S
from loglens.functions.text import tokenize
from loglens.plans.occurrence import match_lines, prepare_snippets


def saved_snippets(requests: DataFrame, frequencies: DataFrame | None = None,
                   pct: int = S.MATCH_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Requests prepared for matching against a stream.

    ``frequencies`` (``word, lines``) of lines seen so far makes matching faster, not different.
    """
    if frequencies is None:
        frequencies = requests.sparkSession.createDataFrame([], "word string, lines bigint")
    return prepare_snippets(requests, frequencies, pct)


def stream_lines(spark: SparkSession, table: str) -> DataFrame:
    """New line documents of a log store, as they are written."""
    full = f"{table.rstrip('/')}/lines"
    return spark.readStream.schema(S.LOG_LINES).option("recursiveFileLookup", True).parquet(full)


def stream_hits(lines: DataFrame, snippets: DataFrame) -> DataFrame:
    """Distinct ``(snippet, node_name)`` of a stream of lines.

    The state is one row per snippet and node with a similar line, however many lines there are.
    """
    if "tokens" not in lines.columns:
        # Never null, or filters on what is made of it would cut every line into words once more.
        lines = lines.withColumn("tokens", F.coalesce(tokenize("message"), F.array().cast("array<string>")))
    return match_lines(lines, snippets).select("snippet", "node_name").dropDuplicates()


def stream_occurrences(lines: DataFrame, saved: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Number of nodes with a similar line per request so far. Write it in ``complete`` or ``update`` mode.

    Lines of a table being written also come from batches that are never committed; as those are ingested
    again, they change no count of distinct nodes.
    """
    asked, snippets = saved
    counts = stream_hits(lines, snippets).groupBy("snippet").agg(F.count(F.lit(1)).alias("nodes"))
    return counts.join(asked.select("query_id", "snippet"), "snippet").select("query_id", "nodes")
