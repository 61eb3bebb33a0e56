"""Text files as numbered lines.

A file up to ``WHOLE_BYTES`` is read whole, as one row, so that its lines are numbered, checked and searched
in one pass. Larger files are split by Spark, and a line's number is not known where the line is read: one
pass counts the lines of each split (and notes the first undecodable line and the first mention of the
product token), which is a tiny table; a second pass adds the split's offset to the position within the
split. Text is never shuffled to be numbered.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loglens import schema as S
from loglens.functions.paths import rel_path
from loglens.session import Staging, is_small
from loglens.sources.listing import glob_escape, root_path


WHOLE_BYTES = 32 << 20


def content_lines(content: Column) -> Column:
    """Lines of binary content, as strings that keep undecodable bytes as they are."""
    text = content.cast("string")
    # Splitting goes through Unicode; one byte per character keeps invalid UTF-8 intact.
    by_bytes = F.transform(F.split(F.decode(content, "ISO-8859-1"), "\n", -1),
                           lambda x: F.encode(x, "ISO-8859-1").cast("string"))
    pieces = F.when(F.is_valid_utf8(text), F.split(text, "\n", -1)).otherwise(by_bytes)
    # Content that ends with a line end leaves an empty piece behind it.
    ended = F.substring(content, -1, 1) == F.lit(b"\n")
    return (F.when(F.octet_length(content) == 0, F.array().cast("array<string>"))
            .when(ended, F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces))


def line_count(content: Column) -> Column:
    """Number of lines of binary content, from its line ends alone."""
    text = content.cast("string")
    ends = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    open_ = (F.octet_length(content) > 0) & (F.substring(content, -1, 1) != F.lit(b"\n"))
    return ends + F.when(open_, 1).otherwise(0)


def with_facts(chunks: DataFrame) -> DataFrame:
    """Add to ``(first_line, content)`` rows the ``bad`` first undecodable line, the first line with the
    product ``token``, and the ``last`` line, without taking the content apart where it has neither.

    ``last`` counts line ends, so that it can be held against the lines that are found."""
    first, content = F.col("first_line"), F.col("content")
    text = content.cast("string")

    def line_where(test):
        return first + F.array_position(F.transform(content_lines(content), test), F.lit(True)) - 1

    return (chunks
            .withColumn("bad", F.when(~F.is_valid_utf8(text), line_where(lambda x: ~F.is_valid_utf8(x))))
            .withColumn("token", F.when(text.contains(S.PRODUCT_TOKEN),
                                        line_where(lambda x: x.contains(S.PRODUCT_TOKEN))))
            .withColumn("last", first + line_count(content) - 1))


def open_whole(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All text files below ``paths``, one row each. Take small ones only."""
    return (spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True)
            .load(paths))


def scan_whole(raw: DataFrame, where) -> DataFrame:
    """``(uri, mtime, first_line, content)`` of the opened files that pass ``where`` and are small."""
    small = F.col("_metadata.file_size") <= WHOLE_BYTES
    return raw.where(where & small).select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_modification_time").alias("mtime"),
        F.lit(1).cast("bigint").alias("first_line"),
        F.col("value").cast("binary").alias("content"))


def open_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All text files below ``paths``, line by line; listed once however many scans are derived from it."""
    return (spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", True)
            .load(paths))


def scan_text(raw: DataFrame, where=None) -> DataFrame:
    """Raw lines ``(uri, mtime, block, mid, value)`` of opened text files.

    ``where`` filters on ``_metadata`` fields; Spark then skips files before opening them. ``mid`` grows
    by one per line within a split. ``.gz`` files are decompressed.
    """
    if where is not None:
        raw = raw.where(where)
    return raw.select(F.col("_metadata.file_path").alias("uri"),
                      F.col("_metadata.file_modification_time").alias("mtime"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("mid"),
                      "value")


def split_stats(raw: DataFrame) -> DataFrame:
    """One row per file split: its lines, first line id, first undecodable and first mentioning line."""
    valid = F.is_valid_utf8("value")
    mid = F.col("mid")
    return raw.groupBy("uri", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("mtime").alias("mtime"),
        F.min(mid).alias("first_mid"),
        F.min(F.when(~valid, mid)).alias("bad_mid"),
        F.min(F.when(valid & F.col("value").contains(S.PRODUCT_TOKEN), mid)).alias("token_mid"))


def place_splits(stats: DataFrame) -> DataFrame:
    """Add to each split ``base`` (line_no = mid + base), and to each file ``last_line`` and ``mentions``.

    ``last_line`` is the line before the first undecodable one: what follows it is not kept. A mention
    counts if it comes before that.
    """
    file = Window.partitionBy("uri")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = stats.withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_mid") + 1)
    total = F.sum("n").over(file)
    first_bad = F.min(F.col("bad_mid") + F.col("base")).over(file)
    first_token = F.min(F.col("token_mid") + F.col("base")).over(file)
    last_line = F.coalesce(first_bad - 1, total)
    return placed.select("uri", "mtime", "block", "base", last_line.alias("last_line"),
                         F.coalesce(first_token <= last_line, F.lit(False)).alias("mentions"))


def attach_splits(raw: DataFrame, splits: DataFrame, *carry: str) -> DataFrame:
    """Number the raw lines, keep those up to ``last_line``, and attach the ``carry`` columns.

    The split table is broadcast if it was counted and is small. If not, both sides are shuffled by
    (file, split): no key holds more than one split, so no key is hot.
    """
    splits = splits.select("uri", "block", "base", "last_line", *carry)
    if is_small(splits):
        splits = F.broadcast(splits)
    return (raw.join(splits, ["uri", "block"])
            .withColumn("line_no", F.col("mid") + F.col("base"))
            .where(F.col("line_no") <= F.col("last_line")))


def read_lines(spark: SparkSession, root: str, paths: list[str] | None = None, where=None) -> DataFrame:
    """``(relpath, line_no, message)`` of text files below ``root``.

    Lines end at ``\\n`` only and are stored without it. The first undecodable line ends its file.
    """
    raw = scan_text(open_text(spark, paths or [glob_escape(root)]), where)
    splits = Staging(spark).table(place_splits(split_stats(raw)), "splits")
    return attach_splits(raw, splits).select(
        rel_path("uri", root_path(spark, root)).alias("relpath"), "line_no",
        F.col("value").alias("message"))
