"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest
from loglens.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"


def brute_force(docs, items, k=20):
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counted:
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * c.total() * n_docs // n_terms)))
                        for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        rows += [(item_id, place, None if none else doc_id, -score) for place, (score, none, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


def found(spark, docs, items, **more):
    out = lexical.rank(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more)
    return sorted(map(tuple, out.collect()), key=str)


def corpus(seed, documents, words):
    """Documents of skewed words with copies, near copies and passages in common; items of some of their words."""
    draw, rows = random.Random(seed), []
    word = lambda: f"w{min(int(draw.paretovariate(0.6)), words)}"
    for _ in range(documents):
        text = [word() for _ in range(draw.choice([1, 5, 40, 200]))]
        rows += [" ".join(text)] * draw.choice([1, 1, 1, 30])
        rows.append(" ".join(w if draw.random() < 0.9 else word() for w in text).upper())
    draw.shuffle(rows)
    items = [("; ".join(draw.choice(rows).split()[:30]) + f" {word()}") for _ in range(25)]
    return list(enumerate(rows)), [(f"i{n}", text) for n, text in enumerate(items)]


@pytest.mark.parametrize("chunk, few, width", [(1_000_000, 128, 32), (300, 8, 1), (5, 1, 2)])
def test_all_documents_scored(spark, monkeypatch, chunk, few, width):
    monkeypatch.setattr(lexical, "WIDTH", width)
    monkeypatch.setattr(lexical.search, "__defaults__", (few,))
    docs, items = corpus(chunk, 60, 400)
    assert found(spark, docs, items, chunk_postings=chunk) == brute_force(docs, items)


def test_search_in_one_place():
    """Over more documents than one session takes quickly, intervals of every kind."""
    import numpy as np
    import pandas as pd
    docs, items = corpus(9, 900, 3000)
    given = lexical.Items.of(list(range(len(items))), [t for _, t in items])
    sent = type("Sent", (), {"value": given})
    rows = pd.concat(lexical._postings(iter([pd.DataFrame(docs, columns=["doc_id", "text"])]), sent))
    n_docs, n_terms = int((rows["n"] > 0).sum()), int(rows["n"].sum())
    weights = np.full(len(given.numbers), lexical.weight(n_docs, 0))
    holding = next(lexical._holding(iter([rows]), len(given.numbers)))
    weights[holding["term"]] = [lexical.weight(n_docs, n) for n in holding["df"]]
    chunk = lexical.Chunk(rows, weights, n_docs, n_terms)
    want = brute_force(docs, items)
    for few, k in ((1, 20), (128, 20), (16, 3)):
        kept = lexical.search(chunk, given.terms, given.times, k, np.ones(len(items), np.int64), few)
        got = [(f"i{i}", d, s) for i, d, s in zip(kept.item.tolist(), chunk.doc_ids[kept.doc].tolist(), kept.score.tolist())]
        assert sorted(got) == sorted((i, d, s) for i, place, d, s in want if place <= k)


def test_blocks_of_items(spark):
    docs, items = corpus(4, 20, 200)
    assert found(spark, docs, items, block_chars=400) == brute_force(docs, items)


def test_defined_cases(spark):
    docs = [(3, "Alpha beta"), (3, "alpha BETA"), (1, "alpha beta"), (None, "alpha beta"), (5, None), (6, ""), (7, "--- !"), (8, "gamma é" * 3000),
            (9, "alpha " * 20000 + "delta"), (10, "É x")]
    items = [("a", "ALPHA"), ("a", "alpha delta"), ("b", None), ("c", ""), ("d", "nowhere"), ("e", "gamma gamma É X"), (None, "beta")]
    assert found(spark, docs, items) == brute_force(docs, items)
    assert found(spark, [], items) == [] == found(spark, docs, [])
    more = spark.createDataFrame([(1, "alpha", "x", 2), (2, "beta", "y", 3)], DOCS + ", item_id string, rank int")
    assert [tuple(r) for r in lexical.rank(more, spark.createDataFrame([("q", "beta", 1, 2)], ITEMS + ", doc_id int, score int")).collect()] == [
        ("q", 1, 2, brute_force([(1, "alpha"), (2, "beta")], [("q", "beta")])[0][3])]


def test_every_document_holds_the_term(spark):
    docs = [(i, "same") for i in range(50)]
    assert found(spark, docs, [("q", "same")]) == brute_force(docs, [("q", "same")])
