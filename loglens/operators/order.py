"""Scan order and resuming from a position in it."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglens.functions.paths import _col
from loglens.session import Staging


def scan_key(path="relpath") -> Column:
    """Sort key. Descending, it puts the children of a directory right before the directory."""
    return F.concat(_col(path), F.lit("/"))


def scan_order(files: DataFrame, path: str = "relpath") -> DataFrame:
    return files.orderBy(scan_key(path).desc())


def scan_ranks(files: DataFrame, staging: Staging, path: str = "relpath", partitions: int | None = None) -> DataFrame:
    """``files`` with ``rank``, their place in scan order from 1, without one task that sees them all.

    Rows are dealt out by ranges of the key and sorted within each; ranges are counted, and each row's place within its range is
    added to the rows before it. Only one row per range goes through a single task.
    """
    key = scan_key(path).desc()
    dealt = files.repartitionByRange(partitions, key) if partitions else files.repartitionByRange(key)
    placed = staging.table(dealt.sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_base"))
    return (placed.join(F.broadcast(base), "_range").withColumn("rank", F.col("_at") + F.col("_base"))
            .drop("_at", "_range", "_base"))


def pending_after(files: DataFrame, cursor: str, path: str = "relpath") -> DataFrame:
    """Entries not yet visited when the scan stopped at ``cursor``; all of them for an empty cursor."""
    if not cursor:
        return files
    return files.where(scan_key(path) < F.lit(cursor.rstrip("/") + "/"))
