"""Archives in parts give what archives in one go give."""

import bz2
import gzip
import io
import os
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from bundles import tar, zipped
from loglens.functions.predicates import is_log_name
from loglens.session import Staging
from loglens.sources import archives as A, parts as P
from loglens.sources.listing import list_files


def zipped_by(method, members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return out.getvalue()


def linked_tar():
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as archive:
        for name, data in (("a.log", b"first\n"), ("b.log", b"other\n"), ("a.log", b"second\n")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
        for name, kind, to in (("hard.log", tarfile.LNKTYPE, "b.log"), ("soft.log", tarfile.SYMTYPE, "b.log"), ("dir", tarfile.DIRTYPE, "")):
            info = tarfile.TarInfo(name)
            info.type, info.linkname = kind, to
            archive.addfile(info)
    return out.getvalue()


def damaged(data, at):
    return data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]


NOISE = random.Random(5).randbytes(60_000)
INNER = zipped({"x.log": b"1\n2", "y.bin": NOISE})
DEFLATED = zipped_by(zipfile.ZIP_DEFLATED, {"one.log": b"line\n" * 9000, "two/deep.txt": b"", "noise.bin": NOISE, "in.zip": INNER,
                                            "in.tar.gz": gzip.compress(tar({"w.log": b"w"}))})
ARCHIVES = {
    "c/deflated.zip": DEFLATED, "c/stored.zip": zipped({"a.log": b"a\nb", "n.tar": tar({"t.log": b"t\n", "u.gz": gzip.compress(b"u")})}),
    "c/bz2.zip": zipped_by(zipfile.ZIP_BZIP2, {"b.log": b"bz\n" * 50}), "c/plain.tar": tar({"p.log": b"p\n" * 500, "q/../../r.log": b"r", "z.zip": INNER}),
    "c/links.tar": linked_tar(), "c/packed.tar": gzip.compress(tar({"g.log": b"g"})), "c/t.tgz": gzip.compress(tar({"h.log": b"h"})),
    "c/odd.tar": bz2.compress(tar({"o.log": b"o"})), "c/file.log.gz": gzip.compress(b"f\ng"), "c/same.txt.zip": zipped({"same.txt": b"only"}),
    "c/d.zip": zipped({"d/x.log": b"1"}), "c/t.tar.zip": zipped({"t.tar": tar({"in.log": b"3"})}), "c/none.zip": zipped({}),
    "c/rivals.zip": zipped({"a.zip": b"no archive", "a.tar": tar({"x.log": b"x"}), "b.zip": zipped({"y.log": b"y"}), "b.tar": tar({"y.log": b"z"})}),
    "c/there.zip": zipped({"a.zip": INNER, "a/x.log": b"there"}), "c/mixed.zip": zipped({"bad.gz": b"no", "ok.log": b"fine"}),
    "bad/head.zip": b"not a zip", "bad/data.zip": damaged(DEFLATED, 60), "bad/noise.zip": damaged(DEFLATED, DEFLATED.index(NOISE[:50]) + 40 if NOISE[:50] in DEFLATED else 40_000),
    "bad/cut.tar": tar({"a.log": NOISE})[:30_000], "bad/short.zip": DEFLATED[:-40], "bad/x.7z": b"7z", "bad/cut.gz": gzip.compress(NOISE)[:9000],
    "bad/stored.zip": damaged(zipped({"a.log": b"abcdefgh" * 40}), 100), "bad/empty.tar": b""}


@pytest.fixture
def listed(spark, tmp_path, put):
    for path, data in ARCHIVES.items():
        put(tmp_path, path, data, 1000)
    return list_files(spark, str(tmp_path))


def collected(expanded):
    members, errors = {}, set()
    for r in expanded.orderBy("archive", "relpath", "chunk_no").collect():
        if r.error is not None:
            errors.add((r.archive, r.relpath))
            continue
        assert r.mtime.timestamp() == 1000
        key = (r.archive, r.relpath)
        members.setdefault(key, [b"", 1])
        assert r.first_line == members[key][1]
        members[key][0] += bytes(r.content)
        members[key][1] += bytes(r.content).count(b"\n")
    return {k: v[0] for k, v in members.items()}, errors


@pytest.mark.parametrize("chunk, range_bytes", [(8 << 20, 256 << 20), (13, 100), (1 << 16, 7)])
def test_the_same_members_as_in_one_go(spark, listed, chunk, range_bytes):
    whole = collected(A.expand_archives(listed))
    parts = collected(P.expand_in_parts(listed, Staging(spark), chunk_bytes=chunk, range_bytes=range_bytes))
    assert parts == whole and len(whole[0]) > 25 and {a for a, _ in whole[1]} >= {k for k in ARCHIVES if k.startswith("bad/")}


def test_unwanted_members_leave_their_name(spark, listed):
    whole = collected(A.expand_archives(listed))
    kept = collected(P.expand_in_parts(listed, Staging(spark), is_log_name()))
    is_log = lambda path: path.endswith((".log", ".txt"))
    assert kept == ({k: v if is_log(k[1]) else b"" for k, v in whole[0].items()}, whole[1])
    assert any(v and not is_log(k[1]) for k, v in whole[0].items())


def test_lines_of_ranges(spark, tmp_path, put):
    draw = random.Random(8)
    data = b"\n".join(draw.randbytes(draw.choice([0, 3, 90])).replace(b"\n", b"") for _ in range(300))
    put(tmp_path, "c/r.tar", tar({"r.log": data, "s.log": data + b"\n", "e.log": b""}), 1000)
    expanded = P.expand_in_parts(list_files(spark, str(tmp_path)), Staging(spark), range_bytes=64, chunk_bytes=40)
    rows = A.member_lines(A.good_members(expanded)).select("relpath", "line_no", F.col("value").cast("binary").alias("v")).collect()
    want = {(f"c/r/{name}.log", n): line for name in "rs" for n, line in enumerate(data.split(b"\n"), 1)}
    assert len(rows) == len(want) and {(r.relpath, r.line_no): bytes(r.v) for r in rows} == want


@pytest.mark.parametrize("name, make", [("big.zip", lambda m: zipped_by(zipfile.ZIP_DEFLATED, m)), ("big.tar", tar)])
def test_one_archive_uses_many_tasks(spark, tmp_path, put, name, make):
    put(tmp_path, f"c/{name}", make({f"{i}.log": os.urandom(1 << 15) for i in range(48)}))
    staging = Staging(spark)
    assert P.expand_in_parts(list_files(spark, str(tmp_path)), staging, task_bytes=1 << 16).select("relpath").distinct().count() == 48
    chunks = spark.read.parquet(f"{staging.path}/member-chunks").groupBy("_metadata.file_path").agg(F.count_distinct("relpath").alias("n")).collect()
    assert len(chunks) >= 12 and max(r.n for r in chunks) <= 12
