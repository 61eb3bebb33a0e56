from loglens import schema as S
from loglens.operators import ledger as L
from loglens.sources.tables import LogTable
import pytest

RECORD = "seq long, start long, stop long, input_dir string, last_path string"


def test_codec(spark):
    good = {'17 230 "/data/my bundles" "host 3/kern.log"': (17, 230, "/data/my bundles", "host 3/kern.log"),
            '5 6 "s3://logs" ""': (5, 6, "s3://logs", ""), '-8 90 "in" "a"': (-8, 90, "in", "a")}
    bad = ['9 3 "/data" ""', '59"/data"""', '5 9"/data" ""', '5 9 "/data"""', "5 9 /data a.log", '9 8 "in" "a"', 'five 9 "in" ""', "", '5 9 "in"']
    parsed = L.parse_ledger(spark.createDataFrame([(l,) for l in [*good, *bad]], "value string"))
    rows = parsed.withColumn("again", L.render_ledger()).withColumn("done", L.is_complete()).collect()
    for row in rows:
        assert row.valid == (row.value in good), row.value
        if row.valid:
            assert (row.start, row.stop, row.input_dir, row.last_path) == good[row.value]
            assert row.again == row.value and row.done == (row.last_path == "")


@pytest.mark.parametrize("records, want", [
    ([], (S.FIRST_WINDOW_START, 5000, "")), ([(1, 30, 700, "in", "")], (700, 5000, "")),
    ([(1, 30, 700, "in", ""), (2, 10, 6100, "in", "host/a.log")], (10, 6100, "host/a.log")),
    ([(2, 30, 8200, "in", ""), (1, 30, 40, "in", "b")], (4999, 5000, ""))])
def test_next_window(spark, records, want):
    row = L.next_window(spark.createDataFrame(records, RECORD), 5000).first()
    assert tuple(row) == want


def test_ledger_of_a_table(spark, tmp_path):
    ledger = LogTable(spark, str(tmp_path / "t")).ledger
    assert ledger.last() is None and tuple(ledger.next_window("in", 1000, 360)) == (S.FIRST_WINDOW_START, 640, "")
    ledger.append(0, 10, "in", ["3", "2"], "b1")
    assert ledger.pending_cases("in", ["1", "2", "3", "4"]) == ["4", "1"]
    assert tuple(ledger.next_window("in", 1000)) == (0, 10, "2") and ledger.batches() == ["b1"]
    assert ledger.pending_cases("other", ["1", "2"]) == ["2", "1"]
    ledger.append(0, 10, "in", [], None)
    assert ledger.last("in")["last_path"] == "" and ledger.pending_cases("in", ["2"]) == ["2"]
    assert tuple(ledger.next_window("in", 1000)) == (10, 640, "")
    with pytest.raises(ValueError):
        ledger.append(5, 5, "in", [], None)
