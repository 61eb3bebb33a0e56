"""Continuous ingest: new files are picked up as they appear."""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from loglens import schema as S
from loglens.functions.paths import rel_path
from loglens.plans.ingest import ingest_batch
from loglens.sources.listing import CASE_GLOB, glob_escape, qualify, root_path
from loglens.sources.tables import LogTable

_BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_ingest(spark: SparkSession, root: str, table: str, checkpoint: str,
                  max_files: int = 10_000, **trigger) -> StreamingQuery:
    """Ingest every file that appears below the case directories of ``root``.

    Files must be moved into place whole: a stream sees a file once and cannot wait until it is old
    enough, as the windows of batch ``ingest`` do. A micro-batch replayed after a failure replaces the
    files it ingested the first time. ``trigger`` defaults to ``availableNow=True``.
    """
    store, where, base = LogTable(spark, table), qualify(spark, root), root_path(spark, root)
    found = (spark.readStream.format("binaryFile").schema(_BINARY_FILE)
             .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
             .load(f"{glob_escape(root.rstrip('/'))}/{CASE_GLOB}")
             .select(F.col("_metadata.file_path").alias("uri")))

    def step(batch: DataFrame, _: int) -> None:
        # At most max_files paths, which the file source holds on the driver anyway.
        rows = batch.select(rel_path("uri", base).alias("relpath")).collect()
        if not rows:
            return
        session = batch.sparkSession
        cases = sorted({r["relpath"].split("/")[0] for r in rows})
        now = int(time.time())
        done = ingest_batch(session, store, root, cases, S.FIRST_WINDOW_START, now + 1,
                            session.createDataFrame([(r["relpath"],) for r in rows], "relpath string"))
        store.ledger.append(S.FIRST_WINDOW_START, now + 1, f"stream:{where}", cases, done)

    return (found.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
