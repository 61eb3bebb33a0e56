"""Decontamination against windows compared one by one."""

import hashlib
import random
import re

import pytest
from loglens.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items):
    out = []
    for doc_id, text in docs:
        doc, hit, found = words(text), set(), set()
        for item_id, item in items:
            item = words(item)
            size = min(10, len(item))
            for s in range(len(item) - size + 1 if item else 0):
                for p in range(len(doc) - size + 1):
                    if doc[p:p + size] == item[s:s + size]:
                        hit |= set(range(p, p + size))
                        found.add(str(item_id))
        ids = ",".join(sorted(found))
        out.append((doc_id, len(doc), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def tables():
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("ab bc cd the of x1 été Ab") if draw.random() < 0.2 else draw.choice("ab bc cd the of x1 été Of".split()) for _ in range(n))
    items = [(i, text(draw.choice([12, 25]))) for i in range(6)] + [(6, "lone"), (7, "two words"), (8, ""), (9, None), (7, "two words")]
    docs = [(100 + i, text(60)) for i in range(10)]
    docs += [(200 + i, f"{text(5)}; {items[i % 6][1]}! {text(9)} {items[(i + 1) % 6][1].upper()}") for i in range(12)]
    docs += [(300, "Lone"), (301, "TWO, words two words lone"), (302, ""), (303, None), (304, "..."), (305, " ".join([items[0][1]] * 30))]
    return docs, items


@pytest.mark.parametrize("limit", [50_000, 3])
def test_hits_are_those_of_all_windows(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)          # beyond it, nothing is broadcast
    docs, items = tables()
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(frame, bench)
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute_force(docs, items))
    kept = decontaminate.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute_force(docs, items) if not r[5])


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "three"), (None, "one two"), (None, None), (1, "one two")], "doc_id long, text string")
    found = decontaminate.contamination(docs, spark.createDataFrame([(1, "one two"), (None, "three")], "item_id long, text string"))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in found.collect()) == sorted(
        [("1", 2, 2, 1), ("1", 2, 2, 1), ("1", 1, 1, 0), ("None", 2, 2, 1), ("None", 0, 0, 0)])


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(none, items).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [0]
