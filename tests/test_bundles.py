"""The data source of files, as a table and as a stream, and lines by byte ranges."""

import random
import time

import pytest
from pyspark.sql import functions as F

import pandas as pd

from loglens.sources import archives, parts
from loglens.sources.bundles import _range_batches, bundle_stream, bundle_tree, file_lines, file_ranges, numbered_lines, range_chunks
from loglens.sources.listing import list_tree

ODD = {"1234567890/.h/.x": "a\nb", "1234567890/_u/_y.log": "", "1234567890/z.bz2": "no codec\n", "1234567890/" + "d/" * 40 + "é +%20=.gz": "deep",
       "2234567890/plain.log": "1\n2\n3\n", "42/outside.log": "no case", "top.log": "no case"}


@pytest.fixture
def root(tmp_path, put):
    for path, text in ODD.items():
        put(tmp_path / "in", path, text, 1000)
    return str(tmp_path / "in")


def test_same_files_as_the_listing(spark, root):
    (lambda p: p.mkdir())(__import__("pathlib").Path(root) / "1234567890" / "hollow")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(bundle_tree(spark, root)) == rows(list_tree(spark, root, ["1234567890", "2234567890"]))
    assert {r.relpath for r in bundle_tree(spark, root, ["42", "nowhere"]).collect()} == {"42/outside.log"}
    assert bundle_tree(spark, root, []).count() == 0


def test_stream_goes_window_by_window(spark, root, tmp_path, put):
    def more(lag_s):
        found = []
        stream = bundle_stream(spark, root, lag_s).select("relpath", F.unix_seconds("mtime").alias("at"), "length")
        (stream.writeStream.foreachBatch(lambda df, _: found.extend(map(tuple, df.collect())))
         .option("checkpointLocation", str(tmp_path / "seen")).trigger(availableNow=True).start().awaitTermination())
        return sorted(found)

    inside = sorted((p, 1000, len(t.encode())) for p, t in ODD.items() if p[:10].isdigit() and "/" in p[:11])
    assert more(360) == inside
    put(tmp_path / "in", "3234567890/.late", "x", int(time.time()) + 100)
    put(tmp_path / "in", "1234567890/late.log", "xy", int(time.time()) - 100)
    assert more(360) == []                                  # too young for a lag of six minutes
    assert more(-50) == [("1234567890/late.log", int((tmp_path / "in/1234567890/late.log").stat().st_mtime), 2)]
    assert [r[0] for r in more(-200)] == ["3234567890/.late"] and more(-200) == []


@pytest.mark.parametrize("range_bytes", [1, 7, 100, 1 << 20])
def test_lines_do_not_depend_on_ranges(spark, tmp_path, put, range_bytes):
    draw = random.Random(range_bytes)
    texts = {f"1234567890/{i}.log": b"\n".join(draw.randbytes(draw.choice([0, 0, 2, 30])).replace(b"\n", b"") for _ in range(draw.randrange(12)))
             + draw.choice([b"", b"\n"]) for i in range(12)}
    for path, data in texts.items():
        put(tmp_path, path, data)
    lines = numbered_lines(file_lines(bundle_tree(spark, str(tmp_path)).where("NOT is_dir"), range_bytes, tasks=3))
    found = {(r.relpath, r.line_no): bytes(r.value) for r in lines.withColumn("value", F.col("value").cast("binary")).collect()}
    assert found == {(p, n): line for p, d in texts.items() for n, line in enumerate(d.removesuffix(b"\n").split(b"\n") if d else [], 1)}


def test_many_small_files_make_few_frames(tmp_path, put, monkeypatch):
    """A data frame for each file costs more than the file; one for all of them would not fit into memory."""
    paths = [str(put(tmp_path, f"{i}.zip", "short")) for i in range(200)]
    files = pd.DataFrame({"relpath": paths, "mtime": pd.Timestamp(0), "length": 5, "source": paths, "part": 0})
    asked = files[["relpath", "mtime", "source"]]
    calls = {"ranges": lambda: _range_batches([files], 1 << 20), "direct": lambda: archives._direct_batches([asked], 1 << 20),
             "index": lambda: parts._index_batches([asked])}
    for name, call in calls.items():
        frames = list(call())
        assert (name, len(frames), sum(map(len, frames))) == (name, 1, 200)
    monkeypatch.setattr(archives, "_BATCH_BYTES", 256 * 50)
    for name, call in calls.items():
        frames = list(call())
        assert 4 <= len(frames) <= 5 and sum(map(len, frames)) == 200, name


def test_frames_are_a_few_megabytes_and_memory_is_given_back(monkeypatch):
    """A frame is held several times over, by the worker and on its way out; a worker that waits holds none of it."""
    given = []
    monkeypatch.setattr(archives, "give_back", lambda: given.append(True))
    frames = list(archives._framed(((i, b"x" * (1 << 20)) for i in range(24)), ["n", "content"], "content"))
    assert [n for f in frames for n in f["n"]] == list(range(24))
    assert max(f["content"].str.len().sum() for f in frames) <= 5 << 20 and given == [True]


@pytest.mark.parametrize("range_bytes", [3, 1 << 20])
def test_ranges_of_files_that_are_still_as_listed(spark, tmp_path, put, range_bytes):
    """Columns of a file go along with its bytes; files that have changed since or are gone are left out."""
    texts = {"a": "1\n22\n\n4444\n5", "empty": "", "changed": "x\n", "gone": "y\n"}
    for name, text in texts.items():
        put(tmp_path, f"1234567890/{name}", text, 1000)
    files = spark.createDataFrame([r.asDict() for r in bundle_tree(spark, str(tmp_path)).where("NOT is_dir").collect()],
                                  "relpath string, uri string, mtime timestamp, length long, is_archive boolean")
    put(tmp_path, "1234567890/changed", "later\n", 2000)
    (tmp_path / "1234567890" / "gone").unlink()
    ranges = file_ranges(files, range_bytes, F.unix_seconds("mtime").alias("seconds"), F.lit("n").alias("node"))
    got = {}
    for r in sorted(range_chunks(ranges, range_bytes).collect(), key=lambda r: (r.relpath, r.part, r.first_line)):
        assert r.node == "n" and r.seconds == 1000
        got.setdefault(r.relpath, []).append(bytes(r.content))
    assert {k: b"".join(v).decode() for k, v in got.items()} == {f"1234567890/{k}": texts[k] for k in ("a", "empty")}
    there = range_chunks(ranges.drop("seconds"), range_bytes, gone=True).where("part = 0").select("relpath").distinct().collect()
    assert {r.relpath for r in there} == {f"1234567890/{k}" for k in ("a", "empty", "changed")}
