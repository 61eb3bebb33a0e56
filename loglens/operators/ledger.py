"""Scan ledger: an append-only table of what was scanned, from which the next window follows."""

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglens import schema as S


def parse_ledger(lines: DataFrame, column: str = "value") -> DataFrame:
    """Ledger columns from text lines ``start stop "input_dir" "last_path"``.

    Adds ``valid``: the line has the four parts, start lies before stop and the directory is not empty.
    """
    text = F.col(column)
    quoted = F.split(text, '"', -1)
    spaced = F.split(text, " ", -1)

    def number(i):
        return F.trim(F.try_element_at(spaced, F.lit(i))).try_cast("bigint")

    start, stop = number(1), number(2)
    input_dir = F.try_element_at(quoted, F.lit(2))
    last_path = F.try_element_at(quoted, F.lit(4))
    valid = ((F.size(spaced) >= 4) & (F.size(quoted) == 5) & start.isNotNull() & stop.isNotNull()
             & (start < stop) & (F.length(input_dir) > 0))
    return lines.select(
        "*", F.when(valid, start).alias("start"), F.when(valid, stop).alias("stop"),
        F.when(valid, input_dir).alias("input_dir"), F.when(valid, last_path).alias("last_path"),
        F.coalesce(valid, F.lit(False)).alias("valid"))


def render_ledger(start="start", stop="stop", input_dir="input_dir", last_path="last_path") -> Column:
    return F.format_string('%d %d "%s" "%s"', F.col(start), F.col(stop), F.col(input_dir), F.col(last_path))


def is_complete(last_path="last_path") -> Column:
    return F.col(last_path) == ""


def last_record(records: DataFrame, seq: str = "seq") -> DataFrame:
    """The record with the highest sequence number (no row if there is none)."""
    names = records.columns
    return (records.agg(F.max_by(F.struct(*[f"`{n}`" for n in names]), F.col(seq)).alias("r"))
            .where(F.col("r").isNotNull()).select("r.*"))


def next_window(records: DataFrame, safe: Column | int) -> DataFrame:
    """``(start, stop, last_path)`` of the next scan; one row.

    After a complete scan it runs from that scan's stop up to ``safe``; after an incomplete one it is the
    same window with the same cursor; with no record it starts in 1900.
    """
    safe = F.lit(safe).cast("bigint") if isinstance(safe, int) else safe
    last = records.agg(F.max_by(F.struct("start", "stop", "last_path"), F.col("seq")).alias("r"))
    first, done = F.col("r").isNull(), F.col("r.last_path") == ""
    return last.select(
        F.when(first, F.lit(S.FIRST_WINDOW_START).cast("bigint"))
        .when(done, F.least(F.col("r.stop"), safe - 1)).otherwise(F.col("r.start")).alias("start"),
        F.when(first | done, safe).otherwise(F.col("r.stop")).alias("stop"),
        F.when(first | done, F.lit("")).otherwise(F.col("r.last_path")).alias("last_path"))


def pending(entries: DataFrame, done: DataFrame, on: str = "relpath") -> DataFrame:
    """Entries not yet done."""
    return entries.join(done.select(on).distinct(), on, "left_anti")


class Ledger:
    """The ledger of one log table. One driver writes it; every record is one committed step."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def records(self, input_dir: str | None = None) -> DataFrame:
        rows = self.spark.read.schema(S.LEDGER).parquet(self.path)
        return rows if input_dir is None else rows.where(F.col("input_dir") == input_dir)

    def append(self, start: int, stop: int, input_dir: str, cases: list[str], batch: str | None) -> None:
        """Record cases as done within a window, or the whole window as complete (no cases)."""
        if not input_dir or start >= stop:
            raise ValueError("a record needs an input directory and start < stop")
        top = self.records().agg(F.max("seq").alias("seq")).first()["seq"] or 0
        rows = [(top + i, start, stop, input_dir, case, case, batch)
                for i, case in enumerate(cases or [""], 1)]
        self.spark.createDataFrame(rows, S.LEDGER).coalesce(1).write.mode("append").parquet(self.path)

    def last(self, input_dir: str | None = None):
        return last_record(self.records(input_dir)).first()

    def next_window(self, input_dir: str, now: int | None = None, lag_s: int = S.SAFETY_LAG_S):
        """Window of the next scan. It stops some minutes back: files still being copied can wait."""
        safe = int(time.time() if now is None else now) - lag_s
        return next_window(self.records(input_dir), safe).first()

    def pending_cases(self, input_dir: str, cases: list[str]) -> list[str]:
        """Cases the current window has not committed yet, in scan order."""
        records = self.records(input_dir)
        upto = records.where(is_complete()).agg(F.max("seq").alias("seq")).first()["seq"] or 0
        done = records.where((F.col("seq") > upto) & (F.col("case") != ""))
        entries = self.spark.createDataFrame([(c,) for c in cases], "`case` string")
        return sorted((r["case"] for r in pending(entries, done, "case").collect()), reverse=True)

    def batches(self) -> list[str]:
        """Committed batches. Data of any other batch is what a failed run left behind."""
        rows = self.records().where(F.col("batch").isNotNull()).select("batch").distinct().collect()
        return sorted(r["batch"] for r in rows)
