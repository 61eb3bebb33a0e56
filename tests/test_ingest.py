import gzip
import time

from pyspark.sql import functions as F
import pytest

from bundles import COMMANDS, LOOSE, NODE, golden_tree, tar, zipped
from loglens import schema as S, session
from loglens.plans.ingest import ingest
from loglens.plans.occurrence import occurrences
from loglens.sources.lines import read_lines
from loglens.sources.listing import list_cases, list_files, only_case_files
from loglens.sources.tables import LogTable, find_lines, table_stats
from loglens.streaming.ingest import stream_ingest

LATER = int(time.time()) + 10_000


@pytest.fixture
def tree(tmp_path, put):
    root = tmp_path / "in"
    return str(root), str(tmp_path / "table"), lambda path, content, mtime=None: put(root, path, content, mtime)


@pytest.fixture(params=["whole", "split"])
def reading(request, monkeypatch):
    """Small files are read whole, large ones by split; with a limit of no bytes every file is large."""
    if request.param == "split":
        monkeypatch.setattr("loglens.sources.lines.WHOLE_BYTES", 0)
        monkeypatch.setattr("loglens.plans.ingest.WHOLE_BYTES", 0)


def contents(spark, table, mode="file"):
    rows = LogTable(spark, table).current_lines(mode).collect()
    return sorted((r.relpath, r.line_no, r.message) for r in rows)


def test_golden_tree(spark, tree, reading):
    root, table, add = tree
    golden_tree(root, lambda _, path, content: add(path, content))
    run = ingest(spark, root, table, now=LATER)
    assert run.complete and run.cases == 3 and run.start == S.FIRST_WINDOW_START
    store = LogTable(spark, table)
    lines = store.current_lines()
    assert lines.schema == S.LOG_LINES
    rows = lines.collect()
    assert len(rows) == 7 and {r.doc_id for r in rows} == {f"{r.relpath}/{r.line_no}" for r in rows}
    inside = [r for r in rows if r.node_name != "Unknown"]
    assert {(r.case, r.grid_id, r.node_name, r.major_version, r.minor_version, r.platform, r.category, r.time_span) for r in inside} == {
        ("3100000042", "north-wing", "host-07", 12, 7, "Unknown", "other", "2021-2022")}
    assert sorted(r.message for r in inside) == sorted(["bycast marker", "bycast kernel up", *COMMANDS.splitlines()])
    assert sorted(r.relpath for r in rows if r.node_name == "Unknown") == ["3100000043/bycast.log", "3100000044/bycast.log"]
    assert len({r.categorize_time for r in rows}) == 1
    assert {tuple(r) for r in occurrences(lines, "bycast").collect()} == {
        ("Occurances", "Occurs", 2), ("Occurances", "Does not occur", 0), ("Occurances by Version", "12", 1),
        ("Occurances by Version", "Unknown", 1), ("Occurances by Platform", "Unknown", 2)}     # files outside any node are one node
    report = store.report()
    assert report.where("lines > 0").count() == 5 and report.where("NOT ok").count() == 0
    assert report.count() == 5 + len(LOOSE) + 2                         # every log file looked at
    assert table_stats(lines, f"{table}/lines").first()["docs"] == 7 < table_stats(lines, f"{table}/lines").first()["bytes"]
    assert find_lines(lines, "node_name", "host-07").count() == 5
    # nothing is new: the next run writes no lines
    again = ingest(spark, root, table, now=LATER)
    assert again.complete and again.start == LATER - S.SAFETY_LAG_S - 1
    assert store.all_lines().count() == 7


def test_top_level(spark, tree):
    root, _, add = tree
    for path in ("123/a.log", "1234567890/a.log", "1234567890/b/c.log", "top.log", "12345678901/a.log", "1234567891"):
        add(path, "x\n")
    assert list_cases(spark, root) == ["1234567890"]
    assert {r.relpath for r in only_case_files(list_files(spark, root)).collect()} == {"1234567890/a.log", "1234567890/b/c.log"}


def test_undecodable_line_ends_its_file(spark, tree, reading):
    root, table, add = tree
    add("1234567890/bycast/a.log", b"ok1\nok2\n\xff\xff\nok4\n")
    add("1234567890/bycast/b.log", b"\xff\xff\xff")
    add("1234567890/c.log", b"no\n\xff\nbycast too late\n")
    add("1234567890/d.log.gz", gzip.compress(b"bycast\r\n\xff\nmore\n"))
    add("1234567890/e.log.gz", gzip.compress(b"\xffbycast\n"))
    ingest(spark, root, table, now=LATER)
    assert contents(spark, table) == [("1234567890/bycast/a.log", 1, "ok1"), ("1234567890/bycast/a.log", 2, "ok2"),
                                      ("1234567890/d.log", 1, "bycast\r")]
    report = {r.relpath: (r.lines, r.ok) for r in LogTable(spark, table).report().collect()}
    assert report == {"1234567890/bycast/a.log": (2, True), "1234567890/bycast/b.log": (0, True), "1234567890/c.log": (0, True),
                      "1234567890/d.log": (1, True), "1234567890/e.log": (0, True)}


def test_archives_and_inheritance(spark, tree, reading):
    root, table, add = tree
    add("1234567890/g1/n1/2018-2019/lumberjack.log", "")      # an empty marker is a marker
    add("1234567890/g1/n1/2018-2019/system_commands", "storage-grid-release-10.4.1\n")
    add("1234567890/g1/n1/2018-2019/os/etc/user_data", "HV_ENV=\"SGA\"\n")
    add("1234567890/g1/n1/2018-2019/deep/x.log", "plain\n")
    add("1234567890/g1/n1/2018-2019/deep/old.tar.gz", gzip.compress(tar({"y.log": b"in tar\n", "z.bin": b"not a log\n"})))
    # a whole bundle inside an archive, whose marker lies in the archive
    add("1234567890/up.zip", zipped({"g2/n2/t/lumberjack.log": b"m\n", "g2/n2/t/messages": b"hello\n",
                                     "g2/n2/t/inner.zip": zipped({"w.log": b"nested\n"}), "loose.log": b"no token\n"}))
    add("1234567890/bad.zip", "bycast but not a zip")
    add("1234567890/same.zip", zipped({"bycast.log": b"from zip\n", "o.log": b"bycast\n"}))
    add("1234567890/same.tar", tar({"bycast.log": b"from tar\n"}))
    add("1234567890/have.zip", zipped({"bycast.log": b"never\n"}))
    add("1234567890/have/bycast.log", "already\n")
    ingest(spark, root, table, now=LATER)
    store = LogTable(spark, table)
    got = {(r.relpath.removeprefix("1234567890/"), r.message): (r.node_name, r.grid_id, r.time_span, r.major_version, r.platform)
           for r in store.current_lines().collect()}
    n1, n2, out = ("n1", "g1", "2018-2019", 10, "SGA"), ("n2", "g2", "Unknown-Unknown", -1, "Unknown"), ("Unknown", "Unknown", "Unknown-Unknown", -1, "Unknown")
    assert got == {
        ("g1/n1/2018-2019/system_commands", "storage-grid-release-10.4.1"): n1, ("g1/n1/2018-2019/deep/x.log", "plain"): n1,
        ("g1/n1/2018-2019/deep/old/y.log", "in tar"): n1, ("up/g2/n2/t/lumberjack.log", "m"): n2, ("up/g2/n2/t/messages", "hello"): n2,
        ("up/g2/n2/t/inner/w.log", "nested"): n2, ("same/bycast.log", "from tar"): out, ("same/o.log", "bycast"): out,
        ("have/bycast.log", "already"): out}
    assert [r.archive for r in store.errors().collect()] == ["1234567890/bad.zip"]


def test_windows_and_replacement(spark, tree):
    root, table, add = tree
    now = 1_000_000_000
    add("1234567890/bycast.log", "a\nb\nc\n", now - 1000)
    add("1234567890/young_bycast.log", "young\n", now - 100)
    first = ingest(spark, root, table, now=now)
    assert (first.start, first.stop) == (S.FIRST_WINDOW_START, now - 360)
    assert [m for _, _, m in contents(spark, table)] == ["a", "b", "c"]
    add("1234567890/bycast.log", "new\n", now)
    second = ingest(spark, root, table, now=now + 1000)
    assert (second.start, second.stop) == (now - 360, now + 640)
    assert contents(spark, table) == [("1234567890/bycast.log", 1, "new"), ("1234567890/young_bycast.log", 1, "young")]
    # with upsert, the tail of the longer first version stays
    assert [m for _, _, m in contents(spark, table, "upsert")] == ["new", "b", "c", "young"]
    store = LogTable(spark, table)
    store.compact(f"{table}-compact")
    assert spark.read.schema(S.LOG_LINES).parquet(f"{table}-compact").count() == 2


def test_interrupted_and_resumed_is_one_run(spark, tree):
    root, table, add = tree
    for case in range(5):
        add(f"123456789{case}/bycast.log", f"{case}\n")
    asked = iter([False, False, True])
    part = ingest(spark, root, table, now=LATER, cases_per_batch=2, should_stop=lambda: next(asked))
    assert not part.complete and part.cases == 4
    assert [m for _, _, m in contents(spark, table)] == ["1", "2", "3", "4"]
    # what a dead run left behind is not seen
    store = LogTable(spark, table)
    store.write("lines", "dead", store.all_lines().drop("batch"))
    assert len(contents(spark, table)) == 4
    rest = ingest(spark, root, table, now=LATER + 5000, cases_per_batch=2)
    assert rest.complete and rest.cases == 1 and (rest.start, rest.stop) == (part.start, part.stop)
    assert [m for _, _, m in contents(spark, table)] == ["0", "1", "2", "3", "4"]


def test_stopped_before_anything_leaves_no_record(spark, tree):
    root, table, add = tree
    add("1234567890/bycast.log", "x\n")
    assert not ingest(spark, root, table, now=LATER, should_stop=lambda: True).complete
    assert LogTable(spark, table).ledger.last() is None


@pytest.mark.parametrize("split", ["1k", "128m"])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, put, split):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name, n in {"c/a.log": 2000, "c/b.log": 1, "c/d/e.txt": 500}.items():
        put(tmp_path, name, "".join(f"{name} {i}\n" for i in range(1, n + 1)))
    put(tmp_path, "c/z.log.gz", gzip.compress(b"c/z.log.gz 1\nc/z.log.gz 2"))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = read_lines(spark, str(tmp_path))
        assert lines.count() == 2503
        assert lines.where(F.col("message") != F.concat_ws(" ", "relpath", F.col("line_no").cast("string"))).count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_stream_picks_up_new_files(spark, tree, tmp_path):
    root, table, add = tree
    golden_tree(root, lambda _, path, content: add(path, content))
    seen = str(tmp_path / "seen")
    stream_ingest(spark, root, table, seen).awaitTermination()
    assert len(contents(spark, table)) == 7
    add(f"{NODE}/late [1].log", "late\n")
    add("3100000044/z.log.gz", gzip.compress(b"bycast in gz\n"))
    stream_ingest(spark, root, table, seen).awaitTermination()
    late = [r for r in LogTable(spark, table).current_lines().collect() if "late" in r.relpath]
    assert [(r.message, r.node_name, r.major_version) for r in late] == [("late", "host-07", 12)]
    assert len(contents(spark, table)) == 9 and len(LogTable(spark, table).ledger.batches()) == 2


def test_split_files_are_numbered_in_ingest(spark, tree, monkeypatch):
    root, table, add = tree
    monkeypatch.setattr("loglens.sources.lines.WHOLE_BYTES", 5000)
    monkeypatch.setattr("loglens.plans.ingest.WHOLE_BYTES", 5000)
    for name, n in {"a": 3000, "b": 1500, "small": 20}.items():
        add(f"1234567890/bycast_{name}.log", "".join(f"line {i}\n" for i in range(1, n + 1)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")      # more splits than output tasks
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        ingest(spark, root, table, now=LATER)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    lines = LogTable(spark, table).current_lines()
    assert lines.count() == 4520 == lines.select("doc_id").distinct().count()
    assert lines.where(F.col("message") != F.concat(F.lit("line "), F.col("line_no").cast("string"))).count() == 0


def test_names_that_readers_pass_over_and_archives_beside_their_content(spark, tree):
    root, table, add = tree
    case = "1234567890/bycast"
    add(f"{case}/syslog.gz", gzip.compress(b"packed syslog\n"))
    add(f"{case}/messages", "plain messages\n")
    add(f"{case}/messages.gz", gzip.compress(b"never\n"))             # already there without its ending
    add(f"{case}/broken.zip", "bycast but no zip")
    add(f"{case}/half.zip", zipped({"x.log": b"bycast\n" * 50})[:60])
    add(f"{case}/.hidden/.x.log", "hidden\n")
    add(f"{case}/_under/y.txt", "under\n")
    add(f"{case}/empty.log", "")
    add(f"{case}/z.bz2/inside.log", "in a directory\n")
    add(f"{case}/syslog.bz2", "bytes as they are\n")                  # the stem decides, not the ending
    ingest(spark, root, table, now=LATER)
    assert [(p.removeprefix(f"{case}/"), m) for p, _, m in contents(spark, table)] == sorted([
        ("syslog", "packed syslog"), ("messages", "plain messages"), (".hidden/.x.log", "hidden"), ("_under/y.txt", "under"),
        ("z.bz2/inside.log", "in a directory"), ("syslog.bz2", "bytes as they are")])
    store = LogTable(spark, table)
    assert {r.archive.removeprefix(f"{case}/") for r in store.errors().collect()} == {"broken.zip", "half.zip"}
    assert {(r.relpath.removeprefix(f"{case}/"), r.lines, r.ok) for r in store.report().where("lines = 0").collect()} == {("empty.log", 0, True)}


def test_scans_are_brought_together_before_joined_tables_are_opened(spark, tree, monkeypatch):
    """Behind the joins, each of a task's many scan partitions would count a joined table once more."""
    root, table, add = tree
    golden_tree(root, lambda _, path, content: add(path, content))
    plans, write = [], LogTable.write
    monkeypatch.setattr(LogTable, "write", lambda self, name, batch, rows: (
        plans.append(rows._jdf.queryExecution().executedPlan().toString()) if name == "lines" else None, write(self, name, batch, rows))[1])
    ingest(spark, root, table, now=LATER)
    assert len(plans) == 1
    for scan in plans[0].split("Scan text ")[:-1]:         # above each scan, the last coalescing stands below the last join
        assert scan.rindex("Coalesce") > scan.rindex("HashJoin")


def test_fields_of_files_beyond_the_broadcast_limit_are_not_copied(spark, tree, monkeypatch):
    """A file is one row on either side: a salt would copy its fields, spread nothing and have the text shuffled again."""
    root, table, add = tree
    golden_tree(root, lambda _, path, content: add(path, content))
    ingest(spark, root, table, now=LATER)
    for function, limit in ((session.is_small, (0,)), (session.join_checked, ("inner", 0)), (session.join_salted, (0,))):
        monkeypatch.setattr(function, "__defaults__", limit)
    plans, write = [], LogTable.write
    monkeypatch.setattr(LogTable, "write", lambda self, name, batch, rows: (
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) if name == "lines" else None, write(self, name, batch, rows))[1])
    ingest(spark, root, f"{table}-shuffled", now=LATER)
    assert contents(spark, f"{table}-shuffled") == contents(spark, table) != []
    assert len(plans) == 1 and "_salt" not in plans[0]


def test_the_driver_holds_no_list_of_files(spark, tree, monkeypatch):
    """Tasks list the files and tasks open them: no plan is made from the paths of a tree."""
    root, table, add = tree
    golden_tree(root, lambda _, path, content: add(path, content))
    read, write, keep = [], LogTable.write, session.Staging.table
    monkeypatch.setattr(LogTable, "write", lambda self, name, batch, rows: (read.extend(rows.inputFiles()), write(self, name, batch, rows))[1])
    monkeypatch.setattr(session.Staging, "table", lambda self, rows, name: (read.extend(rows.inputFiles()), keep(self, rows, name))[1])
    ingest(spark, root, table, now=LATER)
    assert len(contents(spark, table)) == 7
    assert read and not [path for path in read if root in path]


def test_members_beyond_the_broadcast_limit_are_not_copied(spark, tree, monkeypatch):
    """Rows of files and directories hold paths and fields: the driver is not to hold many of them, nor are they to be multiplied."""
    root, table, add = tree
    add("1234567890/up.zip", zipped({"g2/n2/t/lumberjack.log": b"m\n", "g2/n2/t/messages": b"hello\n", "loose.log": b"no token\n"}))
    add("1234567890/n/t/lumberjack.log", "m\n")
    add("1234567890/n/t/pack.tar", tar({"in/x.log": b"1\n2\n"}))
    ingest(spark, root, table, now=LATER)
    monkeypatch.setattr("loglens.plans.ingest.FILE_ROWS", 0)
    plans, write = [], LogTable.write
    monkeypatch.setattr(LogTable, "write", lambda self, name, batch, rows: (
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) if name == "lines" else None, write(self, name, batch, rows))[1])
    ingest(spark, root, f"{table}-shuffled", now=LATER)
    assert contents(spark, f"{table}-shuffled") == contents(spark, table) and len(contents(spark, table)) == 5
    assert len(plans) == 1 and "_salt" not in plans[0] and "broadcast" not in plans[0]
