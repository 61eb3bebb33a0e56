import gzip
import os
from datetime import datetime

from pyspark.sql import functions as F
import pytest

from bundles import tar, zipped
from loglens.sources import archives as A
from loglens.functions.paths import uri_path
from loglens.session import Staging
from loglens.sources.listing import existing_paths, list_files, list_tree
from loglens.sources.parts import expand_in_parts

WHEN = datetime(2020, 1, 1)


@pytest.fixture
def expand(spark):
    def run(archives, **options):
        df = spark.createDataFrame([(p, WHEN, bytearray(b)) for p, b in archives.items()],
                                   "relpath string, mtime timestamp, content binary")
        return A.expand_archives(df, **options).cache()
    return run


def members(expanded):
    rows = A.good_members(expanded).orderBy("relpath", "chunk_no").collect()
    out = {}
    for r in rows:
        out[r.relpath] = out.get(r.relpath, b"") + bytes(r.content)
        assert r.mtime == WHEN
    return out


def test_formats_and_nesting(expand):
    inner = zipped({"zip.txt": b"z\n"})
    got = expand({
        "c/hello_targz.tar.gz": gzip.compress(tar({"folder/targz.txt": b"a\nb\n", "hello_zip.zip": inner})),
        "c/hello_tar.tar": tar({"tar.txt": b"x"}), "c/hello_zip.zip": inner, "c/hello_gz.gz": gzip.compress(b"hi\nyo"),
        "c/x.tgz": tar({"q/../../w.log": b"1\n", "/abs.log": b"2\n"}, "w:gz"), "c/empty.zip": zipped({"e.log": b""}),
        "deep.zip": zipped({"a.tar.gz": gzip.compress(tar({"b.zip": zipped({"c.gz": gzip.compress(b"end")})}))})})
    assert members(got) == {
        "c/hello_targz/folder/targz.txt": b"a\nb\n", "c/hello_targz/hello_zip/zip.txt": b"z\n", "c/hello_tar/tar.txt": b"x",
        "c/hello_zip/zip.txt": b"z\n", "c/hello_gz": b"hi\nyo", "c/x/q/w.log": b"1\n", "c/x/abs.log": b"2\n",
        "c/empty/e.log": b"", "deep/a/b/c": b"end"}
    assert A.archive_errors(got).count() == 0


def test_zip_with_only_its_namesake_is_lifted(expand):
    got = members(expand({"file.txt.zip": zipped({"file.txt": b"only"}), "d.zip": zipped({"d/x.log": b"1", "d/y.log": b"2"}),
                          "two.zip": zipped({"two": b"1", "other": b"2"}), "t.tar.zip": zipped({"t.tar": tar({"in.log": b"3"})})}))
    assert got == {"file.txt": b"only", "d/x.log": b"1", "d/y.log": b"2", "two/two": b"1", "two/other": b"2", "t/in.log": b"3"}


def test_unreadable_archives_leave_only_an_error(expand):
    big = os.urandom(200_000)
    got = expand({"corrupt.tar.gz": b"\x81\x00" * 500, "dir.zip": b"\xff" * 7, "hello_7z.7z": b"7z..", "cut.gz": gzip.compress(big)[:90_000],
                  "cut.tar": tar({"a": big})[:100_000], "cut.tgz": gzip.compress(tar({"a": b"x", "b": big}))[:90_000],
                  "mixed.zip": zipped({"bad.gz": b"no", "ok.log": b"fine"})})
    assert members(got) == {"mixed/ok.log": b"fine"}
    assert {(r.archive, r.error.split(":")[0]) for r in A.archive_errors(got).collect()} == {
        ("corrupt.tar.gz", "BadGzipFile"), ("dir.zip", "BadZipFile"), ("hello_7z.7z", "no decoder for .7z"), ("cut.gz", "EOFError"),
        ("cut.tar", "ReadError"), ("cut.tgz", "EOFError"), ("mixed/bad.gz", "BadGzipFile")}


def test_nested_archive_already_unpacked_is_skipped(expand):
    got = members(expand({"n.zip": zipped({"a.zip": zipped({"x": b"1", "y": b"2"}), "a/x": b"there", "b.gz": gzip.compress(b"new")})}))
    assert got == {"n/a/x": b"there", "n/b": b"new"}


@pytest.mark.parametrize("chunk", [1, 3, 7, 1 << 20])
def test_lines_do_not_depend_on_chunks(expand, chunk):
    content = b"one\n\ntwo\r\nbad \xff\xfe line\nsn\xc3\xb6w\n\nlast"
    got = expand({"f.log.gz": gzip.compress(content), "e.log.gz": gzip.compress(b""), "n.log.gz": gzip.compress(b"\n\n")}, chunk_bytes=chunk)
    lines = A.member_lines(A.good_members(got)).select("relpath", "line_no", F.col("value").cast("binary").alias("v"))
    rows = {(r.relpath, r.line_no): bytes(r.v) for r in lines.collect()}
    assert rows == {**{("f.log", i): l for i, l in enumerate(content.split(b"\n"), 1)}, ("n.log", 1): b"", ("n.log", 2): b""}


def test_opened_from_the_store(spark, tmp_path, put):
    root = tmp_path / "in put"
    put(root, "c/a b+c%20[1].log.gz", gzip.compress(b"x\n"), 1000)
    listed = list_files(spark, str(root))
    rows = A.expand_archives(A.spread_archives(listed)).collect()
    assert [(r.relpath, bytes(r.content), r.mtime.timestamp(), r.error) for r in rows] == [("c/a b+c%20[1].log", b"x\n", 1000.0, None)]


def test_short_unreadable_archives_in_the_store(spark, tmp_path, put):
    bad = {"none.zip": b"", "one.zip": b"x", "short.zip": b"not an archive", "brief.tar": b"ab", "brief.tgz": b"\x1f\x8b", "brief.gz": b"a"}
    for path, content in bad.items():
        put(tmp_path / "in", path, content)
    listed = list_files(spark, str(tmp_path / "in"))
    inline = spark.createDataFrame([(p, WHEN, bytearray(b)) for p, b in bad.items()], "relpath string, mtime timestamp, content binary")
    errors = [{r.archive: r.error for r in A.archive_errors(found).collect()} for found in
              (A.expand_archives(inline), A.expand_archives(listed), expand_in_parts(listed, Staging(spark)))]
    assert errors[0].keys() == bad.keys() and all(errors[0][p].startswith("BadZipFile:") for p in bad if p.endswith(".zip"))
    assert errors[0] == errors[1] == errors[2]


def test_skip_unpacked(spark, tmp_path, put):
    for path in ("c/dir.zip", "c/new.tar.gz", "c/f.log.gz", "c/f.log", "c/dir/deep/x.log", "c/e.zip", "c/h.zip"):
        put(tmp_path, path, "x")
    put(tmp_path, "c/e", "")
    (tmp_path / "c/h").mkdir()
    listed = list_files(spark, str(tmp_path))
    left = A.skip_unpacked(listed.where("is_archive"), existing_paths(listed))
    assert {r.relpath for r in left.collect()} == {"c/new.tar.gz", "c/h.zip"}
    tree = list_tree(spark, str(tmp_path)).selectExpr("relpath AS path")          # empty directories are there too
    assert {r.relpath for r in A.skip_unpacked(listed.where("is_archive"), tree).collect()} == {"c/new.tar.gz"}


def test_every_file_is_listed(spark, tmp_path, put):
    paths = {"c/n/s/empty.log": 0, "c/.hidden/x y.log": 1, "c/_u/.z": 1, "c/a=%20+é[1].log": 1, "d/" + "e/" * 80 + "f": 1}
    for path, size in paths.items():
        put(tmp_path, path, "x" * size, 1000)
    assert {r.relpath: (r.length, r.mtime.timestamp()) for r in list_files(spark, str(tmp_path)).collect()} == {p: (n, 1000.0) for p, n in paths.items()}
    assert {r.relpath for r in list_files(spark, str(tmp_path), ["c/n", "nowhere"]).collect()} == {"c/n/s/empty.log"}
    assert all(plain == f"{tmp_path}/{relpath}" for relpath, plain in
               list_files(spark, str(tmp_path)).select("relpath", uri_path("uri")).collect())
