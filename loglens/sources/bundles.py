"""Files below a directory as a data source, for batch and stream alike, and their lines by byte ranges.

``spark.read.format("bundle_files")`` lists one partition for each of ``names`` (JSON; by default all case directories below
``path``), in tasks; ``spark.readStream`` gives the files of one time window after the other. Either asks the store itself, so files with
hidden names, names that end like a codec's, and empty files are all there, as they are in ``listing.list_tree``.

A stream's offset is a time: a micro-batch holds the files that were last changed in ``[start, stop)``, ``stop`` being ``lag`` seconds ago.
So no list of files seen is kept, and a replayed micro-batch lists the same window again. As with the windows of batch ingest, a
file that gets a time before its window's end only after that window was listed is missed; ``lag`` is there to allow for it.

``file_lines`` and ``range_chunks`` read files by byte ranges; what they give for a file doesn't depend on the ranges.
"""

import json
import time
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from loglens import schema as S
from loglens.functions.paths import plain_uri
from loglens.session import join_checked, ship_package
from loglens.sources.archives import _chunks, _framed, _open, _Slice
from loglens.sources.lines import content_lines
from loglens.sources.listing import open_store, qualify, with_uri
from loglens.sources.parts import _line_start

NAME = "bundle_files"
LISTED = "relpath string, millis long, length long, is_dir boolean"
RANGE_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
ALWAYS = (-2 ** 62, 2 ** 62)


class Listing(InputPartition):
    """One directory whose files and directories last changed in a window are asked for."""

    def __init__(self, name: str, start: int, stop: int):
        super().__init__((name, start, stop))


def _case_names(path: str) -> list[str]:
    from pyarrow import fs
    store, base = open_store(path)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(i.base_name for i in found if i.type == fs.FileType.Directory and len(i.base_name) == 10 and i.base_name.isdigit() and i.base_name.isascii())


class _Options:
    def __init__(self, options):
        self.path, self.lag = options["path"], int(options.get("lag", str(S.SAFETY_LAG_S)))
        self.names = json.loads(options["names"]) if "names" in options else None

    def asked(self) -> list[str]:
        return _case_names(self.path) if self.names is None else self.names

    def read(self, partition: Listing):
        from pyarrow import RecordBatch, fs
        if partition is None:                               # Spark's way to read no partitions at all
            return
        name, start, stop = partition.value
        store, base = open_store(self.path)
        base = base.rstrip("/")
        infos = store.get_file_info(fs.FileSelector(f"{base}/{name}".rstrip("/"), recursive=True, allow_not_found=True))
        infos = [i for i in infos if start <= i.mtime_ns // 1_000_000_000 < stop]
        for at in range(0, len(infos), 50_000):
            part = infos[at:at + 50_000]
            yield RecordBatch.from_pydict({
                "relpath": [i.path[len(base):].lstrip("/") for i in part], "millis": [i.mtime_ns // 1_000_000 for i in part],
                "length": [max(i.size or 0, 0) for i in part], "is_dir": [i.type == fs.FileType.Directory for i in part]})


class BundleReader(_Options, DataSourceReader):
    def partitions(self):
        return [Listing(name, *ALWAYS) for name in self.asked()]


class BundleStreamReader(_Options, DataSourceStreamReader):
    def initialOffset(self):
        return {"before": S.FIRST_WINDOW_START}

    def latestOffset(self):
        return {"before": int(time.time()) - self.lag}

    def partitions(self, start, end):
        return [Listing(name, start["before"], end["before"]) for name in self.asked()] if start["before"] < end["before"] else []


class BundleFiles(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return LISTED

    def reader(self, schema):
        return BundleReader(self.options)

    def streamReader(self, schema):
        return BundleStreamReader(self.options)


def _reader(spark: SparkSession, kind, root: str, names: list[str] | None, **options):
    ship_package(spark)
    spark.dataSource.register(BundleFiles)
    options = {**options, "path": qualify(spark, root), **({} if names is None else {"names": json.dumps(names)})}
    return with_uri(kind.format(NAME).options(**options).load(), options["path"])


def bundle_tree(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """Every file and directory below the case directories of ``root``, or below its directories ``names``."""
    return _reader(spark, spark.read, root, names)


def bundle_stream(spark: SparkSession, root: str, lag_s: int = S.SAFETY_LAG_S) -> DataFrame:
    """The same files as a stream, window by window; directories are left out."""
    return _reader(spark, spark.readStream, root, None, lag=str(lag_s)).where(~F.col("is_dir")).drop("is_dir")


# --- lines -----------------------------------------------------------------------------------------------


def file_lines(files: DataFrame, range_bytes: int = RANGE_BYTES, tasks: int | None = None) -> DataFrame:
    """``(relpath, mtime, block, pos, value)``: each line with the range it begins in and its place there, from 1.

    ``files`` (``relpath``, ``uri``, ``mtime``, ``length``) may be a stream. Bytes are taken as they are: nothing is decompressed, and
    what isn't UTF-8 stays in ``value``. ``tasks`` deals the ranges over so many tasks.
    """
    ship_package(files.sparkSession)
    parts = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1)).cast("int")
    ranges = files.select("relpath", "mtime", "length", plain_uri("uri").alias("source"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    if tasks:
        ranges = ranges.repartition(tasks, "relpath", "part")
    chunks = ranges.mapInPandas(partial(_range_batches, range_bytes=range_bytes), _RANGE)
    return (chunks.select("relpath", "mtime", "block", "first", F.posexplode(content_lines(F.col("content"))).alias("at", "value"))
            .select("relpath", "mtime", "block", (F.col("first") + F.col("at")).alias("pos"), "value"))


_RANGE = "relpath string, mtime timestamp, block long, first long, content binary"


def _range_batches(batches, range_bytes):
    columns = [c.strip().split(" ")[0] for c in _RANGE.split(",")]
    yield from _framed(_range_rows(batches, range_bytes), columns, "content")


def _range_rows(batches, range_bytes):
    for batch in batches:
        for row in batch.itertuples(index=False):
            with _open(row.source) as stream:
                size = int(row.length)
                start, stop = (_line_start(stream, at, size) for at in (row.part * range_bytes, min((row.part + 1) * range_bytes, size)))
                if start < stop:
                    for line, piece in _chunks(_Slice(stream, start, stop), CHUNK_BYTES):
                        yield row.relpath, row.mtime, row.part * range_bytes, line, piece


def file_ranges(files: DataFrame, range_bytes: int, *carry) -> DataFrame:
    """``(relpath, source, length, part, ..carry)``: the ranges to read ``files`` (``relpath``, ``uri``, ``length``) in. Small files have one."""
    parts = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1)).cast("int")
    return files.select("relpath", plain_uri("uri").alias("source"), "length", *carry, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))


def range_chunks(ranges: DataFrame, range_bytes: int, gone: bool = False) -> DataFrame:
    """``ranges`` with the bytes of the lines that begin in each, as chunks of ``(first_line, content)``; lines count from 1 in a range.

    Files whose time is not that of a column ``seconds`` any more are left out, and with ``gone`` those that are no longer there. All
    columns of ``ranges`` go along, so nothing has to be joined to the text. The first range of an empty file has an empty chunk.
    """
    ship_package(ranges.sparkSession)
    made = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema)
    read = partial(_chunk_batches, columns=ranges.columns, range_bytes=range_bytes, gone=gone)
    return ranges.mapInPandas(read, f"{made}, first_line long, content binary")


def _chunk_batches(batches, columns, range_bytes, gone):
    yield from _framed(_chunk_rows(batches, columns, range_bytes, gone), [*columns, "first_line", "content"], "content")


def _chunk_rows(batches, columns, range_bytes, gone):
    source, part, length = (columns.index(c) for c in ("source", "part", "length"))
    seconds = columns.index("seconds") if "seconds" in columns else None
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            if (gone or seconds is not None) and not _is_there(row[source], None if seconds is None else row[seconds]):
                continue
            with _open(row[source]) as stream:
                stream.seek(0, 2)
                size, begin, end = stream.tell(), row[part] * range_bytes, (row[part] + 1) * range_bytes
                start, stop = _line_start(stream, begin, size), size if end >= row[length] else _line_start(stream, end, size)
                if start < stop or begin == 0:
                    for line, piece in _chunks(_Slice(stream, start, stop), CHUNK_BYTES):
                        yield *row, line, piece


def _is_there(source, seconds) -> bool:
    from pyarrow import fs
    store, path = open_store(source)
    info = store.get_file_info(path)
    return info.type == fs.FileType.File and (seconds is None or info.mtime_ns // 1_000_000_000 == seconds)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``(relpath, line_no, value)`` of ``file_lines``: the lines of earlier ranges of a file are counted, not shuffled."""
    counts = lines.groupBy("relpath", "block").agg(F.max("pos").alias("n"))
    before = Window.partitionBy("relpath").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).where("block > 0 and base > 0").drop("n")
    return (join_checked(lines, base, ["relpath", "block"], "left")
            .select("relpath", (F.col("pos") + F.coalesce("base", F.lit(0))).alias("line_no"), "value"))
