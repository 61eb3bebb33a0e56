"""Fingerprints: entropies and neighbours by brute force, likeness of edited texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from loglens.llm import fingerprints as fp

SCHEMA = "doc_id long, text string"


def text(draw, n):
    return " ".join("".join(draw.choice(["th", "er", "on", "é", "an", "re", "st"]) for _ in range(draw.randrange(1, 5))) for _ in range(n))


def test_entropies_are_those_of_each_window():
    data = np.frombuffer(b"aab" * 20 + bytes(range(70)) + b"z" * 40, np.uint8)
    table, levels = fp._C_LOG_C, fp.entropies(data)
    for i in range(len(data) - fp.WINDOW + 1):
        total = sum(int(table[c]) for c in Counter(data[i:i + fp.WINDOW].tolist()).values())
        assert levels[i] == (fp._MOST - total) * fp.LEVELS // fp._MOST


def test_digests_do_not_depend_on_the_texts_beside_them():
    draw, rank = random.Random(1), np.random.default_rng(0).permutation(fp.LEVELS + 1)
    texts = [text(draw, n) for n in (1, 3, 60, 400, 2500, 2)] + ["", "x", "é" * 200]
    alone = [fp.fingerprints_of([t], rank)[0] for t in texts]
    for together, one in zip(fp.fingerprints_of(texts, rank), alone):
        assert np.array_equal(together, one)
    assert len(alone[4]) > 1 and len(alone[6]) == 0 and fp.likeness(alone[6], alone[6]) == 1 and fp.likeness(alone[6], alone[7]) == 0


@pytest.mark.parametrize("range_chars", [100, 10_000_000])
def test_neighbours_and_likeness(spark, range_chars):
    draw = random.Random(4)
    rows = [(i * 7 % 101, text(draw, draw.choice([1, 5, 300]))) for i in range(40)] + [(1000, None), (-3, ""), (2000, text(draw, 4000))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", tie string")
    found = {r.doc_id: r for r in fp.fingerprint(docs, range_chars).collect()}
    ordered = [(i, t or "") for i, t in sorted(rows, reverse=True, key=lambda r: r[0])]
    assert len(found) == len(rows)
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        edited = t[:len(t) - len(t) // 3] + following[:len(t) // 3]
        assert found[i].n_chars == len(t) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_next <= 1
        if len(t) > 300 and len(following) > 300:
            assert found[i].near_edited > 0.4 > found[i].near_next


def test_equal_texts_and_missing_ids(spark):
    rows = [(1, "same text " * 20), (2, "same text " * 20), (1, "same text " * 20), (None, "same text " * 20), (None, None)]
    found = fp.fingerprint(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    assert len({r.fingerprint for r in found if r.n_chars}) == 1 and [r.fingerprint for r in found if not r.n_chars] == [""]
    assert fp.fingerprint(spark.createDataFrame([(1, "only one here " * 9)], SCHEMA)).first().near_next == 1.0
    assert fp.fingerprint(spark.createDataFrame([], SCHEMA)).collect() == []


PERIODIC = ["a" * 1000, "=" * 5000, "ab" * 500, "%&# " * 80, "0123456789" * 90, "abcdefghijk " * 60, "ha " * 300]


def test_every_text_has_a_feature_and_periodic_ones_are_told_apart():
    rank = np.random.default_rng(2).permutation(fp.LEVELS + 1)
    found = fp.fingerprints_of([*PERIODIC, "", *("q" * n for n in range(1, 100))], rank)
    assert all(len(chain) for chain in found[:7] + found[8:]) and len(found[7]) == 0
    for i in range(8):
        for j in range(8):
            assert fp.likeness(found[i], found[j]) == 1 if i == j else fp.likeness(found[i], found[j]) < 0.1
    a, b = fp.fingerprints_of(["ab" * 500, "ab" * 900], rank)
    assert fp.likeness(a, b) == 1
    draw = random.Random(8)
    body = text(draw, 100)
    a, b = fp.fingerprints_of([body + "ab" * 3000, body + "=-" * 3000], rank)
    assert fp.likeness(a, b) < 1


@pytest.mark.parametrize("size", [9, 31, 63, 94, 135, 159, 255, 256, 1000])
def test_texts_that_differ_in_length_by_a_little_are_alike(size):
    draw, rank = random.Random(size), np.random.default_rng(3).permutation(fp.LEVELS + 1)
    for _ in range(10):
        body, other = ("".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size + 2)) for _ in range(2))
        a, b, c = fp.fingerprints_of([body[:size], body, other], rank)
        assert fp.likeness(a, b) > 0.5 and fp.likeness(a, c) < 0.2


def test_selection_is_that_of_brute_force():
    draw, rank = random.Random(6), np.random.default_rng(4).permutation(fp.LEVELS + 1)
    for body in [text(draw, 90), "ab" * 200 + text(draw, 30), "z" * 90, text(draw, 15)]:
        data = body.encode()
        padded, levels, starts, counts = fp.windows_of([data])
        wide = fp._hashes(padded)[1]
        keys = [int(rank[levels[i]]) << 53 | int(wide[i]) >> 11 for i in range(counts[0])]
        assert len({data[i:i + fp.WINDOW] for i in range(counts[0])}) == len(set(keys))
        spans = [min(keys[i:i + fp.SPAN]) for i in range(max(0, len(keys) - fp.SPAN + 1))]
        chosen = {k for k, n in Counter(spans).items() if n >= fp.POINTS}
        chosen |= set(sorted(set(keys) - chosen)[:max(0, fp.LEAST - len(chosen))])
        got = fp._selected(np.array(keys), np.array(spans, np.int64))
        assert set(got.tolist()) == chosen and len(got) == len(chosen)
    hashes = np.random.default_rng(5).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    for x in (hashes, np.repeat(hashes[:200], 30), hashes[:100]):
        assert np.array_equal(fp._least_short(x), np.unique(x)[:fp.SHORT_FEATURES])
