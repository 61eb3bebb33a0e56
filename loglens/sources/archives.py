"""Archives as rows: every archive expands, in one task of its own, into its member files.

Spark spreads the archives over tasks; the task streams each one through the standard decoders, so
memory stays at one chunk. Decoded members wait in a spooled temporary file until their archive turned
out readable, because an unreadable archive must leave nothing behind but its error row.
"""

import gzip
import io
import shutil
import tarfile
import zipfile
from functools import partial
from os.path import basename, dirname, splitext
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from loglens import schema as S
from loglens.functions.paths import plain_uri, strip_all_archive_exts
from loglens.session import give_back, ship_package
from loglens.sources.lines import content_lines
from loglens.sources.listing import open_store

CHUNK_BYTES = 8 << 20
SPOOL_BYTES = 64 << 20
# Files up to this size are opened by reading them.
SMALL_BYTES = 64 << 10
_BATCH_BYTES = 4 << 20


def skip_unpacked(archives: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop archives whose name without archive extensions already exists as a file or directory."""
    unpacked = existing.select(F.col("path").alias("unpacked"))
    return archives.join(unpacked, strip_all_archive_exts("relpath") == F.col("unpacked"), "left_anti")


def expand_archives(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Members of archives, nested ones included.

    ``archives`` has ``relpath`` and ``mtime`` and either ``content`` (the bytes) or ``uri`` (opened by
    the task, so that archives of any size stream through). Result: see ``schema.MEMBERS``. A member
    comes as chunks that end at line ends; ``first_line`` numbers a chunk's first line. Rows with
    ``error`` stand for unreadable archives. Members carry the time of the outermost archive. To do
    something with every member, ``transform`` the result.
    """
    ship_package(archives.sparkSession)
    source = F.col("content") if "content" in archives.columns else plain_uri("uri")
    return (archives.select("relpath", "mtime", source.alias("source"))
            .mapInPandas(partial(_expand_batches, chunk_bytes=chunk_bytes), S.MEMBERS))


def spread_archives(archives: DataFrame, target_bytes: int = 128 << 20) -> DataFrame:
    """Deal archives over enough tasks for each to hold about ``target_bytes`` of them."""
    spark = archives.sparkSession
    size = archives.agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    wanted = max((size["bytes"] or 0) // target_bytes, 2 * spark.sparkContext.defaultParallelism)
    return archives.repartition(int(max(1, min(wanted, size["n"]))), "relpath")


def good_members(expanded: DataFrame) -> DataFrame:
    return expanded.where(F.col("error").isNull()).drop("error")


def archive_errors(expanded: DataFrame) -> DataFrame:
    """Archives, outer or nested, that could not be read, with the reason."""
    return expanded.where(F.col("error").isNotNull()).select(F.col("relpath").alias("archive"), "error")


def member_lines(members: DataFrame, *carry: str) -> DataFrame:
    """``(..carry, relpath, line_no, value)`` of member chunks. Undecodable bytes stay as they are."""
    return (members.select(*carry, "relpath", "first_line",
                           F.posexplode(content_lines(F.col("content"))).alias("pos", "value"))
            .withColumn("line_no", F.col("first_line") + F.col("pos")).drop("first_line", "pos"))


# --- inside the task -------------------------------------------------------------------------------


class Unreadable(Exception):
    pass


def _open(source):
    if isinstance(source, (bytes, bytearray, memoryview)):
        return io.BytesIO(source)
    store, path = open_store(source)
    stream = store.open_input_file(path)
    if stream.size() > SMALL_BYTES:
        return stream
    with stream:                            # decoders that look for a trailer may seek before the start of a short file:
        return io.BytesIO(stream.read())    # they know the error that Python's own files give


def _clean(name: str) -> str:
    """Member name without anything that could lead out of its archive."""
    return "/".join(p for p in name.replace("\\", "/").split("/") if p not in ("", ".", ".."))


def _read_gz(stream, target):
    spool = SpooledTemporaryFile(SPOOL_BYTES)
    with gzip.GzipFile(fileobj=stream) as unzipped:
        shutil.copyfileobj(unzipped, spool, CHUNK_BYTES)
    yield target, spool


def _read_tar(stream, target):
    head = stream.read(2)
    stream.seek(0)
    if head == b"\x1f\x8b":
        _, stream = next(_read_gz(stream, target))
        stream.seek(0)
    tar = tarfile.open(fileobj=stream, mode="r:*")      # not closed here: its members are read later
    last = {_clean(m.name): m for m in tar.getmembers() if m.isreg() or m.islnk()}
    for name, member in last.items():
        yield f"{target}/{name}", tar.extractfile(member)


def _read_zip(stream, target):
    with zipfile.ZipFile(stream) as archive:
        infos = {_clean(i.filename): i for i in archive.infolist()}
        spool, places = SpooledTemporaryFile(SPOOL_BYTES), []
        for name, info in infos.items():
            if name and not info.is_dir():
                start = spool.tell()
                with archive.open(info) as member:
                    shutil.copyfileobj(member, spool, CHUNK_BYTES)
                places.append((name, start, spool.tell()))
    # An archive that holds only its own namesake is that file or directory.
    stem = basename(target)
    lifted = {n.split("/")[0] for n in infos if n} == {stem}
    for name, start, stop in places:
        yield (f"{dirname(target)}/{name}".lstrip("/") if lifted else f"{target}/{name}",
               _Slice(spool, start, stop))


_READERS = {".gz": _read_gz, ".tar": _read_tar, ".tgz": _read_tar, ".zip": _read_zip}


class _Slice(io.RawIOBase):
    """A byte range of a seekable file, itself seekable."""

    def __init__(self, parent, start, stop):
        self.parent, self.start, self.stop, self.at = parent, start, stop, start

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self.at - self.start

    def seek(self, offset, whence=io.SEEK_SET):
        origin = {io.SEEK_SET: self.start, io.SEEK_CUR: self.at, io.SEEK_END: self.stop}[whence]
        self.at = max(self.start, origin + offset)
        return self.tell()

    def read(self, size=-1):
        left = max(0, self.stop - self.at)
        self.parent.seek(self.at)
        data = self.parent.read(left if size is None or size < 0 else min(size, left))
        self.at += len(data)
        return data

    def readinto(self, buffer):
        data = self.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


def _expand(path, stream, taken):
    """Yield ``(member path, stream)`` or ``(archive path, Unreadable)``, archives within archives to any depth."""
    waiting = [(path, stream)]
    while waiting:
        path, stream = waiting.pop()
        if not _is_archive(path):
            yield path, stream
            continue
        stem, ext = splitext(basename(path))
        target = f"{dirname(path)}/{stem}".lstrip("/")
        if target in taken:
            continue
        try:
            if ext not in _READERS:
                raise Unreadable(f"no decoder for {ext}")
            stream.seek(0)
            found = list(_READERS[ext](stream, target))
        except Exception as e:  # decoders raise many kinds of errors on bad input
            yield path, e if isinstance(e, Unreadable) else Unreadable(f"{type(e).__name__}: {e}")
            continue
        for name, _ in found:
            while name and name not in taken:
                taken.add(name)
                name = dirname(name)
        waiting += reversed(found)


def _is_archive(name):
    return splitext(basename(name))[1] in S.ARCHIVE_EXTENSIONS


def _chunks(stream, chunk_bytes):
    """Yield ``(first line, bytes)`` pieces that end at line ends; one empty piece for an empty file."""
    stream.seek(0)
    held, line, empty = [], 1, True
    while block := stream.read(chunk_bytes):
        cut = block.rfind(b"\n") + 1
        if not cut:
            held.append(block)
            continue
        piece = b"".join([*held, block[:cut]])
        held, empty = [block[cut:]] if cut < len(block) else [], False
        yield line, piece
        line += piece.count(b"\n")
    if held or empty:
        yield line, b"".join(held)


def _framed(rows, columns, content=None):
    """Rows, the bytes of whose ``content`` column count, in data frames of about ``_BATCH_BYTES``.

    A frame is held several times over on its way out. Behind the last one the worker gives back what it took."""
    held, size, at = [], 0, None if content is None else columns.index(content)
    for row in rows:
        held.append(row)
        size += 256 + (0 if at is None else len(row[at] or b""))
        if size >= _BATCH_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)
        held = []
    give_back()


def _expand_batches(batches, chunk_bytes):
    rows = (row for batch in batches for relpath, mtime, source in batch.itertuples(index=False)
            for row in _archive_rows(relpath, mtime, source, chunk_bytes))
    yield from _framed(rows, S.MEMBERS.names, "content")


def direct_rows(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Files (``relpath``, ``uri``, ``mtime``) as their own only member, read by tasks as the bytes they are."""
    ship_package(files.sparkSession)
    rows = files.select("relpath", "mtime", plain_uri("uri").alias("source")).mapInPandas(
        partial(_direct_batches, chunk_bytes=chunk_bytes), S.MEMBERS)
    return good_members(rows)


def _direct_batches(batches, chunk_bytes):
    yield from _framed(_direct_rows(batches, chunk_bytes), S.MEMBERS.names, "content")


def _direct_rows(batches, chunk_bytes):
    for batch in batches:
        for relpath, mtime, source in batch.itertuples(index=False):
            with _open(source) as stream:
                for n, (line, piece) in enumerate(_chunks(stream, chunk_bytes)):
                    yield relpath, relpath, mtime, n, line, piece, None


def _archive_rows(relpath, mtime, source, chunk_bytes):
    try:
        stream = _open(source)
    except Exception as e:
        yield relpath, relpath, mtime, None, None, None, f"cannot open: {type(e).__name__}: {e}"
        return
    with stream:
        for path, member in _expand(relpath, stream, set()):
            if isinstance(member, Unreadable):
                yield relpath, path, mtime, None, None, None, str(member)
                continue
            for n, (line, piece) in enumerate(_chunks(member, chunk_bytes)):
                yield relpath, path, mtime, n, line, piece, None
