from pyspark.sql import functions as F

from loglens import schema as S
from loglens.functions import fields as FF
from loglens.functions.predicates import in_window, is_log_name, parse_version
from loglens.operators.relevance import is_relevant, relevant_files
from loglens.operators.scope import resolve_scope, sidecar_fields
import pytest


def test_case_and_span(evaluate):
    assert evaluate(FF.case_number, ["3100000042", "/srv/in/3100000043", "/srv", "case", "/", "/srv/in/310"]) == [
        "3100000042", "3100000043"] + ["Unknown"] * 4
    assert evaluate(FF.time_span, ["k/from-to", "20212022", "k/20210301-20210302", "7-8"]) == [
        "Unknown-Unknown", "Unknown-Unknown", "20210301-20210302", "7-8"]
    assert evaluate(FF.node_name, ["/a/b/c", "/a", "/"]) == ["b", "", ""]
    assert evaluate(FF.grid_id, ["/a/b/c", "/a/b", "/a"]) == ["a", "", ""]


def test_category(evaluate):
    cases = {"k/host/7-8/services/bycast.log": "bycast", "host/7-8/services/servermanager.log": "server_manager",
             "host/7-8/system_commands": "system_commands", "k/host/7-8": "other", "todo.log": "other",
             "host/9-10/services/messages": "messages", "bycast.log": "other", "x/server/manager": "server_manager", "x\\server\\manager": "server_manager",
             "upgrade/audit.log": "audit", "x/base_os/some_command": "base_os_commands"}
    assert dict(zip(cases, evaluate(FF.category_of, cases))) == cases


def test_version_line(evaluate):
    cases = {"storage-grid-release-12.7.3-20210917.1100.cafe77": (12, 7), "is storage-grid-release-8.15\r": (8, 15),
             "storage-grid-release-x.y": (-1, -1), "storage-grid-release-10": (-1, -1),
             "storage-grid-release-1.2storage-grid-release-3.4": (-1, -1), "storage-grid-release- 9 . 0 .1": (9, 0)}
    assert [tuple(r) for r in evaluate(FF.release_version, cases)] == list(cases.values())


def test_platform_line(evaluate):
    cases = {"": None, "COLOR=blue": None, "HV_ENV is unset": None, "\tHV_ENV = \"mainframe\" ;": None,
             " HV_ENV =  '\"SGA\"';": "SGA", "HV_ENV=vSphere": "vSphere", "HV_ENV=SGA=x": "SGA"}
    assert evaluate(FF.platform_of, cases) == list(cases.values())


def _sidecar(spark, rows):
    return sidecar_fields(spark.createDataFrame(
        [(path, 0, i, bytearray(line)) for i, (path, line) in enumerate(rows)],
        "relpath string, block long, mid long, value binary").withColumn("value", F.col("value").cast("string")))


def test_sidecars(spark):
    found = {r.dir: (r.platform, r.major_version, r.minor_version) for r in _sidecar(spark, [
        ("a/system_commands", b"x"), ("a/system_commands", b"storage-grid-release-10.4.0"),
        ("a/system_commands", b"storage-grid-release-11.0.0"),
        ("a/os/etc/user_data", b"HV_ENV=BAD"), ("a/os/etc/user_data", b"HV_ENV=SGA"), ("a/os/etc/user_data", b"HV_ENV=vSphere"),
        ("b/system_commands", b"storage-grid-release-x"), ("b/system_commands", b"storage-grid-release-9.1.0"),
        ("c/system_commands", b"\xff"), ("c/system_commands", b"storage-grid-release-9.1.0"),
        ("d/system_commands", b"one\rstorage-grid-release-9.3.1\rstorage-grid-release-1.1.1")]).collect()}
    assert found == {"a": ("SGA", 10, 4), "b": (None, -1, -1), "c": (None, None, None), "d": (None, 9, 3)}


@pytest.mark.parametrize("rows", [400_000, 0])
def test_inheritance_is_per_field(spark, rows):
    scopes = spark.createDataFrame([
        ("c/g", 2, "outer", "grid", "1-2", "kern", "SGA", 10, 1),
        ("c/g/n", 3, "inner", "Unknown", "Unknown-Unknown", "other", "Unknown", -1, -1),
        ("c/g/n/x", 4, "Unknown", "Unknown", "Unknown-Unknown", "syslog", "vSphere", 11, -1)], S.SCOPES)
    dirs = spark.createDataFrame([("c/g/n/x/y",), ("c/g/n",), ("c",), ("c/g-other",)], "dir string")
    got = {r.dir: tuple(r)[1:] for r in resolve_scope(dirs, scopes, rows).collect()}
    nothing = ("Unknown", "Unknown", "Unknown-Unknown", "other", "Unknown", -1, -1)
    assert got == {"c/g/n/x/y": ("inner", "grid", "1-2", "syslog", "vSphere", 11, -1),
                   "c/g/n": ("inner", "grid", "1-2", "kern", "SGA", 10, 1), "c": nothing, "c/g-other": nothing}


def test_log_names(evaluate):
    cases = {"a.log": True, "b/a.txt": True, "syslog": True, "x/syslog.1": True, "messages.gz": True, "system_commands": True,
             "dir/dir": False, "a.LOG": False, ".log": False, "syslog.1.2": False}
    assert evaluate(is_log_name, cases) == list(cases.values())


def test_relevance(spark):
    files = spark.createDataFrame([
        ("plain.log", "Unknown"), ("bycast.txt", "Unknown"), ("bycast/kern.log", "Unknown"), ("says.txt", "Unknown"),
        ("n/plain.log", "host-07"), ("n/sub/os.txt", "host-07"), ("n/syslog", "host-07"), ("n/sub/core", "host-07")],
        "relpath string, node_name string")
    lines = spark.createDataFrame([("says.txt", "so says bycast"), ("plain.log", "By Cast"), ("n/sub/core", "bycast")],
                                  "relpath string, message string")
    want = {"bycast.txt", "bycast/kern.log", "says.txt", "n/plain.log", "n/sub/os.txt", "n/syslog"}
    assert {r.relpath for r in relevant_files(files, lines).collect()} == want
    flagged = files.withColumn("m", F.col("relpath") == "says.txt").where(is_relevant(F.col("m")))
    assert {r.relpath for r in flagged.collect()} == want


def test_window(spark):
    times = spark.sql("SELECT timestamp_seconds(s) AS mtime, s FROM VALUES (0), (1000), (1500.9), (1999.999), (2000), (3000) t(s)")
    assert [float(r.s) for r in times.where(in_window(1000, 2000)).orderBy("s").collect()] == [1000.0, 1500.9, 1999.999]


def test_version_choices():
    assert parse_version(None)[0] == parse_version("")[0] == parse_version("All Versions")[0] == "all"
    assert parse_version("Pre-10")[0] == "pre10"
    assert parse_version("10.4") == ("exact", 10, 4) and parse_version("Unknown") == ("exact", -1, -1)
    with pytest.raises(ValueError):
        parse_version("10")
