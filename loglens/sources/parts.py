"""Archives in parts: first a table of members, then their bytes, read by as many tasks as these call for.

A zip file's directory and a tar file's headers say where each member lies, so a light task per archive makes the
member table without reading content. Members are dealt to tasks by their bytes; a task opens the archive at a member's
place and decodes that member only. A large member that is stored as it is, is read in ranges of its own, whose lines are
numbered afterwards from the ranges' line counts. Nothing waits in memory or on disk for its archive to prove readable: rows of
archives that turn out not to be are dropped by a join.

Compressed streams (``.gz``, ``.tgz``) have no places to start at. They, and the few archives whose nested archives compete for one
path, are read as ``archives.expand_archives`` does.
"""

import struct
import tarfile
import zipfile
import zlib
from functools import partial
from os.path import dirname, splitext
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loglens import schema as S
from loglens.functions.paths import is_archive, plain_uri
from loglens.session import Staging, join_checked, ship_package
from loglens.sources.archives import (CHUNK_BYTES, SPOOL_BYTES, _archive_rows, _chunks, _clean, _expand, _framed, _is_archive, _open,
                                      _Slice, spread_archives)
from loglens.sources.lines import line_count

# Bytes of members that one task reads, and of a stored member that are read in one place.
TASK_BYTES = 128 << 20
RANGE_BYTES = 256 << 20

MEMBER_TABLE = ("archive string, source string, mtime timestamp, member_no long, relpath string, kind string, at long, "
                "stored long, size long, crc long, error string")
_COLUMNS = [c.strip().split(" ")[0] for c in MEMBER_TABLE.split(",")]


def member_table(archives: DataFrame) -> DataFrame:
    """One row for each member of ``archives`` (``relpath``, ``mtime``, ``uri``): its path, where its bytes lie and how they are stored.

    ``kind`` is ``bytes``, ``deflate``, ``zip`` (other methods), ``sparse`` or ``whole`` (the archive has to be read in one go). Rows with
    ``error`` stand for unreadable archives. Members of members are not looked for here.
    """
    ship_package(archives.sparkSession)
    return archives.select("relpath", "mtime", plain_uri("uri").alias("source")).mapInPandas(_index_batches, MEMBER_TABLE)


def expand_in_parts(archives: DataFrame, staging: Staging, wanted: Column | None = None, chunk_bytes: int = CHUNK_BYTES,
                    task_bytes: int = TASK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Members of archives, nested ones included, as ``schema.MEMBERS``; see ``archives.expand_archives``.

    Of members whose ``relpath`` isn't ``wanted`` only the name is left; their bytes are checked all the same.
    """
    table = staging.table(member_table(spread_archives(archives)), "member-table")
    keep = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    split = (F.col("kind") == "bytes") & F.col("crc").isNull() & ~is_archive("relpath") & (F.col("size") > range_bytes)
    parts = F.when(split, F.ceil(F.col("size") / range_bytes)).otherwise(1).cast("int")
    asked = (table.where("error is null").withColumn("keep", keep | is_archive("relpath"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
             .withColumn("start", F.when(split, F.col("part") * F.lit(range_bytes)).otherwise(0).cast("long"))
             .withColumn("stop", F.when(split, F.least((F.col("part") + 1) * F.lit(range_bytes), "size")).otherwise(F.col("size")).cast("long")))
    total = asked.agg(F.sum("stored").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    cores = archives.sparkSession.sparkContext.defaultParallelism
    tasks = int(max(1, min(max((total["bytes"] or 0) // task_bytes, 2 * cores), total["n"])))
    dealt = asked.repartition(tasks, "archive", "member_no", "part")
    read = dealt.mapInPandas(partial(_read_batches, chunk_bytes=chunk_bytes), "part int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in S.MEMBERS))
    bare = ~(keep | F.col("error").isNotNull())
    read = read.where(~bare | (F.col("chunk_no") == 0)).withColumn("content", F.when(bare, F.lit(b"")).otherwise(F.col("content")))
    read = staging.table(read, "member-chunks")
    if not table.where("error is null").where(split).isEmpty():
        read = _numbered(read)
    lost = (F.col("error").isNotNull()) & (F.col("relpath") == F.col("archive"))
    errors = (table.where("error is not null").select("archive", "mtime", "error").unionByName(read.where(lost).select("archive", "mtime", "error"))
              .groupBy("archive").agg(F.min("mtime").alias("mtime"), F.min("error").alias("error")))
    errors = staging.table(errors, "unreadable")
    good = join_checked(read.where(~lost).select(*S.MEMBERS.names), errors.select("archive"), "archive", "left_anti")
    nothing = [F.lit(None).cast(S.MEMBERS[c].dataType).alias(c) for c in ("chunk_no", "first_line", "content")]
    return good.unionByName(errors.select("archive", F.col("archive").alias("relpath"), "mtime", *nothing, "error"))


def _numbered(read: DataFrame) -> DataFrame:
    """Chunks whose ``first_line`` counts from the start of the member and not of its range."""
    lines = read.where("error is null").groupBy("archive", "relpath", "part").agg(F.sum(line_count(F.col("content"))).alias("n"))
    member = Window.partitionBy("archive", "relpath").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = lines.withColumn("base", F.coalesce(F.sum("n").over(member), F.lit(0))).where("part > 0 and base > 0").drop("n")
    return (join_checked(read, base, ["archive", "relpath", "part"], "left")
            .withColumn("first_line", F.col("first_line") + F.coalesce("base", F.lit(0))).drop("base"))


# --- inside the task: the member table ---------------------------------------------------------------


def _zip_members(stream, target):
    with zipfile.ZipFile(stream) as archive:
        infos = {_clean(i.filename): i for i in archive.infolist()}
    lifted = {n.split("/")[0] for n in infos if n} == {target.rsplit("/", 1)[-1]}
    for name, info in infos.items():
        if name and not info.is_dir():
            if info.flag_bits & 1:
                raise zipfile.BadZipFile("encrypted")
            kind = {zipfile.ZIP_STORED: "bytes", zipfile.ZIP_DEFLATED: "deflate"}.get(info.compress_type, "zip")
            path = f"{dirname(target)}/{name}".lstrip("/") if lifted else f"{target}/{name}"
            yield path, kind, info.header_offset, info.compress_size, info.file_size, info.CRC


def _tar_members(stream, target):
    with tarfile.open(fileobj=stream, mode="r:") as tar:
        for name, member in {_clean(m.name): m for m in tar.getmembers() if m.isreg() or m.islnk()}.items():
            while member.islnk():
                member = tar.getmember(member.linkname)
            kind = "sparse" if member.issparse() else "bytes"
            yield f"{target}/{name}", kind, member.offset if kind == "sparse" else member.offset_data, member.size, member.size, None


def _members(relpath, stream):
    stem, ext = splitext(relpath.rsplit("/", 1)[-1])
    target = f"{dirname(relpath)}/{stem}".lstrip("/")
    head = stream.read(262)
    stream.seek(0)
    if ext == ".zip":
        found = list(_zip_members(stream, target))
    elif ext == ".tar" and head[257:262] == b"ustar":
        found = list(_tar_members(stream, target))
    else:
        found = None
    if found is None or _rivals([f[0] for f in found]):
        return [(relpath, "whole", 0, 0, 0, None)]
    taken = _with_dirs(f[0] for f in found)
    return [f for f in found if not _is_archive(f[0]) or splitext(f[0])[0] not in taken]


def _with_dirs(names):
    taken = set()
    for name in names:
        while name and name not in taken:
            taken.add(name)
            name = dirname(name)
    return taken


def _rivals(names):
    """Whether what one nested archive expands to depends on what another does."""
    seen, taken = set(), _with_dirs(names)
    for name in filter(_is_archive, names):
        target = splitext(name)[0]
        if target in taken:
            continue
        while _is_archive(target):
            target = splitext(target)[0]
        if target in seen or target in taken:
            return True
        seen.add(target)
    return False


def _index_batches(batches):
    for made in _framed(_index_rows(batches), _COLUMNS):
        yield made.astype({c: "Int64" for c in ("member_no", "at", "stored", "size", "crc")})


def _index_rows(batches):
    for batch in batches:
        for relpath, mtime, source in batch.itertuples(index=False):
            try:
                with _open(source) as stream:
                    size = stream.seek(0, 2)
                    size = stream.tell() if size is None else size
                    stream.seek(0)
                    rows = [(relpath, source, mtime, n, path, kind, at, stored if kind != "whole" else size, full, crc, None)
                            for n, (path, kind, at, stored, full, crc) in enumerate(_members(relpath, stream))]
            except Exception as e:  # decoders raise many kinds of errors on bad input
                rows = [(relpath, source, mtime, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}")]
            yield from rows


# --- inside the task: the bytes of a member ------------------------------------------------------------


def _blocks(stream, kind, at, stored, chunk_bytes):
    """Decoded blocks of a zip member."""
    stream.seek(at)
    header = stream.read(30)
    if header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("bad magic number of a member")
    names, extra = struct.unpack("<HH", header[26:30])
    if kind == "zip":
        stream.seek(0)
        with zipfile.ZipFile(stream) as archive:
            with archive.open(next(i for i in archive.infolist() if i.header_offset == at)) as member:
                while block := member.read(chunk_bytes):
                    yield block
        return
    data = _Slice(stream, at + 30 + names + extra, at + 30 + names + extra + stored)
    inflate = zlib.decompressobj(-15) if kind == "deflate" else None
    while block := data.read(chunk_bytes):
        while inflate and block:
            yield inflate.decompress(block, chunk_bytes)
            block = inflate.unconsumed_tail
        if not inflate:
            yield block
    if inflate:
        yield inflate.flush()
        if not inflate.eof:
            raise zipfile.BadZipFile("a member ends early")


def _checked(blocks, size, crc):
    """The same blocks; an error behind them if they aren't what the archive's directory says."""
    seen, length = 0, 0
    for block in blocks:
        seen, length = zlib.crc32(block, seen), length + len(block)
        yield block
    if (seen, length) != (crc, size):
        raise zipfile.BadZipFile("bad CRC-32 of a member")


class _Blocks:
    """Blocks as a stream that is read once, from its start."""

    def __init__(self, blocks):
        self.blocks, self.held = blocks, b""

    def seek(self, at):
        return at

    def read(self, size):
        parts, have = [self.held], len(self.held)
        while have < size and (block := next(self.blocks, None)) is not None:
            parts.append(block)
            have += len(block)
        data = b"".join(parts)
        self.held = data[size:]
        return data[:size]


def _line_start(stream, at, size):
    """Where the first line begins that begins at ``at`` or behind it."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    stream.seek(at - 1)
    at -= 1
    while block := stream.read(1 << 16):
        if (end := block.find(b"\n")) >= 0:
            return at + end + 1
        at += len(block)
    return size


def _member_chunks(row, stream, chunk_bytes):
    """``(relpath, chunk_no, first_line, content, error)`` of a member, or of the members it holds."""
    if row.kind == "sparse":
        with tarfile.open(fileobj=stream, mode="r:") as tar:
            data = tar.extractfile(next(m for m in tar if m.offset == row.at))
            yield from _named(row.relpath, data, chunk_bytes)
        return
    if pd.isna(row.crc):
        data = _Slice(stream, int(row.at), int(row.at + row.size))
    else:
        blocks = _checked(_blocks(stream, row.kind, int(row.at), int(row.stored), chunk_bytes), int(row.size), int(row.crc))
        if not row.keep:
            for _ in blocks:
                pass
            yield row.relpath, 0, 1, b"", None
            return
        data = _Blocks(blocks)
        if _is_archive(row.relpath):
            spool = SpooledTemporaryFile(SPOOL_BYTES)
            for block in blocks:
                spool.write(block)
            data = spool
    if not row.keep:
        yield row.relpath, 0, 1, b"", None
        return
    if row.start or row.stop < row.size:
        a, b = (_line_start(data, at, int(row.size)) for at in (int(row.start), int(row.stop)))
        if a < b:
            for n, (line, piece) in enumerate(_chunks(_Slice(stream, int(row.at) + a, int(row.at) + b), chunk_bytes)):
                yield row.relpath, (row.part << 12) + n, line, piece, None
        return
    yield from _named(row.relpath, data, chunk_bytes)


def _named(relpath, data, chunk_bytes):
    if not _is_archive(relpath):
        for n, (line, piece) in enumerate(_chunks(data, chunk_bytes)):
            yield relpath, n, line, piece, None
        return
    for path, member in _expand(relpath, data, set()):
        if isinstance(member, Exception):
            yield path, None, None, None, str(member)
            continue
        for n, (line, piece) in enumerate(_chunks(member, chunk_bytes)):
            yield path, n, line, piece, None


def _rows_of(row, chunk_bytes):
    if row.kind == "whole":
        for out in _archive_rows(row.archive, row.mtime, row.source, chunk_bytes):
            yield row.part, *out
        return
    try:
        with _open(row.source) as stream:
            for path, n, line, piece, error in _member_chunks(row, stream, chunk_bytes):
                yield row.part, row.archive, path, row.mtime, n, line, piece, error
    except Exception as e:  # as above
        yield row.part, row.archive, row.archive, row.mtime, None, None, None, f"{type(e).__name__}: {e}"


def _read_batches(batches, chunk_bytes):
    rows = (row for batch in batches for asked in batch.itertuples(index=False) for row in _rows_of(asked, chunk_bytes))
    yield from _framed(rows, ["part", *S.MEMBERS.names], "content")
