"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglens.session import give_back, ship_package

# Texts are worked on in runs of about so many characters, so that a task's memory doesn't follow its batch.
RUN_CHARS = 2_000_000
# Of Spark's own batches, where workers hold much else; Spark's default is 10,000 rows, or 64 MB.
BATCH_BYTES = "2m"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def on_executors(df: DataFrame) -> DataFrame:
    """``df``, after the package was sent to where its functions will run."""
    ship_package(df.sparkSession)
    return df


def runs(batches: Iterator[pd.DataFrame], text: str = "text", chars: int = RUN_CHARS) -> Iterator[pd.DataFrame]:
    """The rows of ``batches`` in runs of about ``chars`` characters; null texts become empty."""
    for batch in batches:
        batch[text] = batch[text].where(batch[text].notna(), "")
        ends = np.cumsum(batch[text].str.len().to_numpy(dtype=np.int64) + 1)
        start = 0
        while start < len(batch):
            stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + chars)) + 1
            yield batch.iloc[start:stop]
            start = stop


def small_batches(spark: SparkSession) -> None:
    """Have Spark send texts to the workers in batches of at most about ``BATCH_BYTES``, unless the session says otherwise.

    A batch is held several times over: in the executor's buffers, in the worker's, and as strings there.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def tidied(made: Iterator) -> Iterator:
    """All that ``made`` gives in a worker, which waits for its next task without the memory that it took."""
    yield from made
    give_back()


def lower_ascii(text) -> Column:
    """``text`` with A-Z lower-cased and nothing else; pure ASCII takes the faster way."""
    text = F.col(text) if isinstance(text, str) else text
    translated = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(translated)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
