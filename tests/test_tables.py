"""Latest documents of ids that are sent again."""

import random

import pytest

from loglens.sources import tables as TB


def sent(seed):
    draw = random.Random(seed)
    keys = [None, *(f"k{i}" for i in range(50))]
    return [(draw.choice(keys), draw.choice([None, 1, 2, 3, 4]), i) for i in range(120)] + [(f"once{i}", i, 1000 + i) for i in range(30)]


@pytest.mark.parametrize("small", [True, False])
def test_one_latest_document_of_each_id(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(TB, "is_small", lambda df: False)
    rows = [r for r in sent(3) if small or r[1] is not None]
    found = TB.latest_documents(spark.createDataFrame(rows, "doc_id string, categorize_time int, v int")).collect()
    newest = {}
    for key, at, _ in rows:
        newest[key] = max(newest.get(key, -1), -1 if at is None else at)
    assert {r.doc_id: -1 if r.categorize_time is None else r.categorize_time for r in found} == newest and len(found) == len(newest)
    assert {tuple(r) for r in found} <= set(rows)


def test_only_ids_and_times_are_shuffled_of_documents_sent_once(spark, tmp_path):
    rows = [(f"k{i}", i, f"text {i}") for i in range(100)] + [("k1", 500, "again")]
    spark.createDataFrame(rows, "doc_id string, categorize_time int, message string").write.parquet(str(tmp_path / "lines"))
    latest = TB.latest_documents(spark.read.parquet(str(tmp_path / "lines")))
    assert latest.where("doc_id = 'k1'").first().message == "again" and latest.count() == 100
    plan = latest._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and plan.count("Exchange hashpartitioning") == len(shuffles) == 1      # of what was sent again, behind its filter
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "ilter coalesce(_again" in below
