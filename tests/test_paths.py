import os
import random

from pyspark.sql import functions as F
import pytest

from loglens.functions import paths as P
from loglens.operators.order import pending_after, scan_order


def test_extension_and_stem(evaluate):
    given = ["kern.log.1", ".profile", "host.a/disk", "v1.2/core.tar.bz2", ".cfg/x", "", "q.", "..k.z", "....", "n"]
    assert evaluate(P.file_ext, given) == [os.path.splitext(os.path.basename(p))[1] for p in given]
    assert evaluate(P.file_stem, given) == [os.path.splitext(os.path.basename(p))[0] for p in given]
    assert evaluate(lambda c: P.file_ext(P.trim_path(c)), ["disk.img/", ".k/m.n.o/"]) == [".img", ".o"]


def test_trim_join_parent(evaluate):
    assert evaluate(P.trim_path, ["a/", "a//", "/", ""]) == ["a", "a", "", ""]
    assert evaluate(lambda c: P.trim_path(c, keep_root=True), ["/mnt/", "/", ""]) == ["/mnt", "/", ""]
    assert evaluate(lambda c: P.join_path(c, F.lit("x")), ["a", "", "a/"]) == ["a/x", "x", "a/x"]
    with pytest.raises(Exception, match="absolute"):
        evaluate(lambda c: P.join_path(c, F.lit("/x")), ["a"])
    given = ["a/b/c", "/a", "a", "/", "a//b", "/a/b/"]
    assert evaluate(P.dir_name, given) == [os.path.dirname(p) for p in given]
    assert evaluate(P.base_name, given) == [os.path.basename(p) for p in given]


def test_normalize(evaluate):
    given = ["/srv/./logs/", "/srv/x/../logs", "/../up", "/p//q/./..", "/m/n/../../o/"]
    assert evaluate(P.normalize_path, given) == [os.path.normpath(p) for p in given]


def test_strip_archive_extensions(evaluate):
    assert evaluate(P.strip_all_archive_exts, ["/k.zip.gz.tar.tgz", "m.log.7z.zip", ".cfg.gzip.gz", ".tar", "d/.zip"]) == [
        "/k", "m.log", ".cfg.gzip", ".tar", "d/.zip"]
    assert evaluate(P.strip_archive_ext, ["d/core.zip.tar.gz", "/.cfg", "d/m.tgz.7z", "m.log", "k..gz"]) == [
        "d/core.zip.tar", "/.cfg", "d/m.tgz", "m.log", "k."]
    assert evaluate(P.is_archive, ["a.gz", "a.GZ", "a.7z", ".gz", "a.log"]) == [True, False, True, False, False]


def test_ancestors(evaluate):
    assert evaluate(P.ancestors, ["a/b/c", "a", ""]) == [["a", "a/b", "a/b/c"], ["a"], []]


def test_scan_order(spark):
    names = ["k", "k!", "k-1", "k.log", "k/a", "k/a/b", "k/a-b", "k0", "m", "m/k", "mm", "B", "b"]
    # backwards, as if every name ended with "/": a directory comes after what it holds and before what extends its name
    paths = sorted(names, key=lambda p: p + "/", reverse=True)
    shuffled = random.Random(3).sample(paths, len(paths))
    rows = scan_order(spark.createDataFrame([(p,) for p in shuffled], "relpath string")).collect()
    assert [r.relpath for r in rows] == paths


def test_resume(spark):
    top = ["zeta.log", "mid", "low", "alpha"]
    entries = spark.createDataFrame([(p,) for p in top], "relpath string")
    for cursor, left in {"": top, "zeta.log": top[1:], "mid/inner/x.log": top[1:], "mid": top[2:], "alpha": []}.items():
        assert sorted(r.relpath for r in pending_after(entries, cursor).collect()) == sorted(left), cursor
    # a name that goes on with a character below "/" comes after the directory it extends
    odd = spark.createDataFrame([("z-a",), ("z/b",)], "relpath string")
    assert [r.relpath for r in pending_after(odd, "z").collect()] == ["z-a"]
