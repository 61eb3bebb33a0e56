"""Language ID: held-out accuracy and the back-off by hand."""

import random
import zlib

import numpy as np
from loglens.llm import langid

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["stre", "unt", "ock"], "cc": ["ña", "ée", "où"]}


def documents(n=300):
    draw = random.Random(2)
    rows = []
    for i in range(n):
        lang = draw.choice(list(SYLLABLES))
        words = ["".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randrange(1, 5))) for _ in range(draw.randrange(1, 30))]
        rows.append((i, " ".join(words).title(), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = documents()
    found = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_labels_are_not_learned_from(spark):
    rows = [(i, t, lang if zlib.crc32(str(i).encode()) % 3 != 1 else "wrong") for i, t, lang in documents(120)]
    assert "wrong" not in {r.lang_pred for r in langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_back_off_takes_the_longest_gram_known():
    scores = {g: np.array([i, -i], np.float32) for i, g in enumerate(["b", "ab", "^ab", "a", "b$"])}
    model = {"languages": ["x", "y"], "tables": {"word": (["known"], np.array([[9, 0]], np.float32)),
                                                 **{n: ([g for g in scores if len(g) == n], np.array([scores[g] for g in scores if len(g) == n])) for n in (1, 2, 3)}}}
    words = langid.WordScores(model)
    assert words.back_off(["ab"]).tolist() == [np.mean([scores["^ab"], scores["b$"]], axis=0).tolist()]
    draw = random.Random(4)
    many = ["".join(draw.choice("abñ") for _ in range(draw.randrange(1, 9))) for _ in range(200)]
    for word, row in zip(many, words.back_off(many)):
        longest = [next((scores[g] for g in ending if g in scores), None) for ending in langid.grams(word)]
        assert np.allclose(row, np.mean([s for s in longest if s is not None] or [[0, 0]], axis=0)), word
    words.learn({"known", "ab"})
    assert words.scores[words["known"]].tolist() == [9, 0]
    names, shares = words.predict(["12 ½ _", "known", ""])
    assert names == ["und", "x", "und"] and shares[0] == shares[2] == 0 and shares[1] > 0.99


def test_texts_without_spaces_are_not_kept_for_good(monkeypatch):
    model = {"languages": ["x"], "tables": {1: (["字"], np.array([[1]], np.float32))}}
    monkeypatch.setattr(langid, "CACHED_BYTES", 50_000)
    words = langid.WordScores(model)
    for i in range(50):
        assert words.predict(["字" * 5_000 + chr(0x4E00 + i)])[0] == ["x"]
        assert words.held < 50_000 + 4 * 5_001 + 1_000 and len(words) <= 4


def test_defined_cases(spark):
    rows = documents(60) + [(900, None, "aa"), (901, "", "bb"), (902, "12 !", None), (None, "kalo mi", None), (3, "kalo mi", "aa"), (903, "x" * 100_000, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    found = [r for r in langid.identify(docs).collect()]
    assert len(found) == len(rows)
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {900, 901, 902}
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    unlabelled = langid.identify(spark.createDataFrame([(1, "words here", None)], SCHEMA)).first()
    assert (unlabelled.lang_pred, unlabelled.score) == ("und", 0.0)
    assert langid.identify(spark.createDataFrame([], SCHEMA)).collect() == []
