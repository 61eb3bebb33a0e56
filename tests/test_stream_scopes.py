"""A stream of files in any order ends up with what batch ingest gives."""

import gzip
import random
import time

import pandas as pd
import pytest

from bundles import golden_tree, tar, zipped
from loglens import schema as S
from loglens.plans.ingest import ingest
from loglens.sources.tables import LogTable
from loglens.streaming.scopes import CaseScopes, resolved, stream_scoped_ingest

LATER = int(time.time()) + 10_000


def rows(spark, table):
    kept = [n for n in S.LOG_LINES.names if n != "categorize_time"]
    return sorted(map(str, LogTable(spark, table).current_lines().select(*[f"`{n}`" for n in kept]).collect()))


def bundle():
    """Nodes within nodes, files outside any, archives that need the fields around them, and an archive with a node in it."""
    files = {}
    golden_tree(None, lambda _, path, content: files.__setitem__(path, content))
    top = "1234567890/g1/n1/2018-2019"
    files |= {f"{top}/lumberjack.log": "", f"{top}/system_commands": "storage-grid-release-10.4.1\n", f"{top}/os/etc/user_data": 'HV_ENV="SGA"\n',
              f"{top}/deep/x.log": "plain\n", f"{top}/deep/in/2020-2021/lumberjack.log": "m\n", f"{top}/deep/in/2020-2021/y.txt": "inner\n",
              f"{top}/deep/old.tar.gz": gzip.compress(tar({"y.log": b"in tar\n", "z.bin": b"no log\n"})), f"{top}/deep/m.log.gz": gzip.compress(b"a\nb"),
              "1234567890/up.zip": zipped({"g2/n2/t/lumberjack.log": b"m\n", "g2/n2/t/messages": b"hello\n", "loose.log": b"no token\n"}),
              "1234567890/other.log": "nothing", "1234567890/said.log": "bycast\n", "1234567890/bad.zip": "no zip",
              "1234567890/have.zip": zipped({"bycast.log": b"never\n"}), "1234567890/have/bycast.log": "already\n"}
    return files


@pytest.mark.parametrize("order", ["logs first", 3])
def test_any_order(spark, tmp_path, put, order):
    files = bundle()
    late = lambda p: p.rsplit("/", 1)[-1] in ("lumberjack.log", "system_commands", "user_data")
    paths = sorted(files)
    parts = {"logs first": [[p for p in paths if not late(p)], [p for p in paths if p.endswith("system_commands")],
                            [p for p in paths if late(p) and not p.endswith("system_commands")]]}.get(order)
    if parts is None:
        random.Random(order).shuffle(paths)
        parts = [paths[i::3] for i in range(3)]
    parts = [sorted(p + [q for q in ("1234567890/have/bycast.log",) if any("have.zip" in x for x in p)]) for p in parts]
    table = str(tmp_path / "table")
    for n, part in enumerate(parts):
        for path in part:
            put(tmp_path / "in", path, files[path], LATER - 3000 + 500 * n)
        lag = int(time.time()) - (LATER - 3000 + 500 * n + 100)
        stream_scoped_ingest(spark, str(tmp_path / "in"), table, str(tmp_path / "seen"), lag_s=lag).awaitTermination()
    whole = str(tmp_path / "whole")
    ingest(spark, str(tmp_path / "in"), whole, now=LATER)
    assert rows(spark, table) == rows(spark, whole) and len(rows(spark, table)) > 15
    assert LogTable(spark, table).corrections().count() > 0
    bad = {(r.archive, r.error) for r in LogTable(spark, table).errors().collect()}
    assert bad == {(r.archive, r.error) for r in LogTable(spark, whole).errors().collect()} and bad


def test_nearest_scope_that_has_a_field():
    none = "Unknown"
    scopes = {
        "c": (True, "n0", none, "1-2", "other", "SGA", -1, -1), "c/a": (False, "x", "x", "x", "x", "x", 1, 1),
        "c/a/b": (True, "n1", "g1", "Unknown-Unknown", "kern", none, 11, -1)}
    assert resolved("c/a/b/d", scopes) == ("n1", "g1", "1-2", "kern", "SGA", 11, -1)
    assert resolved("c/a", scopes) == ("n0", none, "1-2", "other", "SGA", -1, -1)
    assert resolved("z", scopes) == (none, none, "Unknown-Unknown", "other", none, -1, -1)


def test_waiting_files_are_forgotten(spark, tmp_path, put):
    """With timers, a marker that comes after the wait corrects what is stored but brings back nothing."""
    def run(wait_s):
        query = stream_scoped_ingest(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "seen"), lag_s=0, wait_s=wait_s,
                                     processingTime="1 second")
        return query
    put(tmp_path / "in", "1234567890/g/n/1-2/lost.log", "nothing\n")
    put(tmp_path / "in", "1234567890/g/n/1-2/said.log", "bycast\n")
    query, store = run(1), LogTable(spark, str(tmp_path / "table"))
    try:
        until = time.time() + 90
        while len(store.ledger.batches()) < 1 and time.time() < until:
            time.sleep(1)
        time.sleep(8)
        put(tmp_path / "in", "1234567890/g/n/1-2/lumberjack.log", "m\n")
        while len(store.ledger.batches()) < 2 and time.time() < until:
            time.sleep(1)
    finally:
        query.stop()
    assert sorted((r.message, r.node_name) for r in store.current_lines().collect()) == [("bycast", "n"), ("m", "n")]


class KeptState(dict):
    """A map state that counts what is written to it."""

    written = 0
    getValue, containsKey, removeKey = dict.__getitem__, dict.__contains__, dict.pop

    def updateValue(self, key, value):
        self[key], self.written = value, self.written + 1

    def iterator(self):
        return iter(list(self.items()))


def test_state_is_written_once_a_directory():
    case = CaseScopes(60, False)
    case.scopes, case.dirs, case.waiting = KeptState(), KeptState(), KeptState()
    marker = ("marker", None, "c/n", None, pd.Timestamp(0), 0, False, "n", "g", "t", "k", None, -1, -1)
    files = [("file", f"c/{d}/{i}.log", f"c/{d}", "u", pd.Timestamp(0), 1, False, *[None] * 5, -1, -1) for d in ("n", "o") for i in range(50)]
    columns = ["kind", "relpath", "dir", "uri", "mtime", "length", "is_archive", *S.SCOPE_FIELDS]
    out = pd.concat(case.handleInputRows(("c",), iter([pd.DataFrame([marker, *files], columns=columns)]), None))
    assert len(out) == 100 and set(out[out["dir"] == "c/n"]["node_name"]) == {"n"} and len(case.waiting) == 50
    assert case.dirs.written == 2


COLUMNS = ["kind", "relpath", "dir", "uri", "mtime", "length", "is_archive", *S.SCOPE_FIELDS]


def file_row(path, length=1):
    return ("file", path, path.rsplit("/", 1)[0], "u", pd.Timestamp(0), length, False, *[None] * 5, -1, -1)


def case_with(monkeypatch, **limits):
    for name, value in limits.items():
        monkeypatch.setattr(f"loglens.streaming.scopes.{name}", value)
    case = CaseScopes(60, False)
    case.scopes, case.dirs, case.waiting, case.packs = KeptState(), KeptState(), KeptState(), KeptState()
    clock = iter(range(1, 1000))
    monkeypatch.setattr("loglens.streaming.scopes.time.time", lambda: next(clock))

    def send(*rows):
        out = pd.concat(case.handleInputRows(("c",), iter([pd.DataFrame(list(rows), columns=COLUMNS)]), None))
        return sorted((r.relpath, r.node_name, r.length) for r in out.itertuples() if r.kind == "read")
    return case, send


MARKER = ("marker", None, "c/n", None, pd.Timestamp(0), 0, False, "n", "g", "t", "k", None, -1, -1)


def test_many_waiting_files_cost_few_rows_of_state(monkeypatch):
    """A row for each of millions of files would take a call each to write, to change and to delete."""
    case, send = case_with(monkeypatch)
    paths = [f"c/{'n' if i % 2 else 'o'}/{i}.log" for i in range(25_000)]
    assert len(send(*map(file_row, paths))) == len(paths)
    assert case.waiting.written + case.packs.written == 3 and case.dirs.written == 2
    assert send(MARKER) == sorted((p, "n", 1) for p in paths if p.startswith("c/n/"))
    assert case.waiting.written + case.packs.written == 6 and sum(len(files) for _, files in case._waits()) == 12_500
    assert send(("marker", None, "c/o", *MARKER[3:])) == sorted((p, "n", 1) for p in paths if p.startswith("c/o/"))
    assert not case.waiting and not case.packs


def test_a_file_that_comes_again_waits_once(monkeypatch):
    """In packs, beside them, and in the batch of the marker: only the latest is read, and packs are put together as they grow."""
    case, send = case_with(monkeypatch, PACK_FROM=3, PACK_ROWS=4, FOLD_FROM=20)
    paths = [f"c/n/{i}.log" for i in range(10)]
    for length in range(1, 6):
        send(*[file_row(p, length) for p in paths])
        assert sum(k[2] for k in case.packs) <= 50
    send(file_row(paths[0], 77), file_row("c/o/x.log"))
    assert sum(k[2] for k in case.packs) < 50 and any(k[1] for k in case.packs)         # 50 came in packs
    assert send(MARKER, file_row(paths[1], 99)) == sorted([(paths[0], "n", 77), (paths[1], "n", 99), *[(p, "n", 5) for p in paths[2:]]])
    assert [f[0] for _, files in case._waits() for f in files] == ["c/o/x.log"]
