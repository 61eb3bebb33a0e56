"""Line documents: a line with the fields of its file."""

from pyspark.sql import Column, DataFrame, functions as F

from loglens import schema as S
from loglens.functions.text import doc_id, tokenize
from loglens.session import join_checked

CARRIED = ("case", *S.SCOPE_FIELDS)


def with_ingest_time(df: DataFrame, millis: int | None = None) -> DataFrame:
    """Stamp the ingest time: one value for the whole batch, so one value per file."""
    now = F.current_timestamp() if millis is None else F.timestamp_millis(F.lit(millis))
    return df.withColumn("categorize_time", now)


def as_documents(lines: DataFrame, message: Column | None = None) -> DataFrame:
    """Shape lines that already carry their file's fields into ``schema.LOG_LINES``."""
    message = F.col("message") if message is None else message
    return (lines.withColumn("message", message)
            .withColumn("doc_id", doc_id("relpath", "line_no"))
            .withColumn("tokens", tokenize("message"))
            .select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in S.LOG_LINES]))


def line_documents(lines: DataFrame, file_fields: DataFrame, millis: int | None = None) -> DataFrame:
    """Documents from ``(relpath, line_no, message)`` lines and one row of fields per file."""
    carried = file_fields.select("relpath", *[f"`{c}`" for c in CARRIED])
    return as_documents(with_ingest_time(join_checked(lines, carried, "relpath"), millis))
