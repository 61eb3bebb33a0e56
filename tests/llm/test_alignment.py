"""Alignment against a version that follows the definition token by token."""

import hashlib
import random
import re
from collections import Counter

import pytest
from loglens.llm import alignment

SCHEMA = "doc_id long, text string"
PIECES = [" ", "  ", "\n", "\t", "\r\n", " ", "　", "a", "word", "Word,", "Ünï", "'s", "12", "!?", "</s>", "<|endoftext|>", "<0x0A>",
          "日本語", "\U0001f642", "́", "\x1c", "\x85", "     ", "ﬁ", "antidisestablishment", "\x00", "▁"]


@pytest.fixture(scope="module")
def tokenizers():
    """Both, with the library of the first tokenizer's file to compare with."""
    from tokenizers import Tokenizer
    both = alignment.Tokenizers((alignment.first_path(), alignment.second_path()))
    both.tokenizer = Tokenizer.from_file(alignment.first_path())
    both.tokenizer.encode_special_tokens = True
    return both


def direct(tokenizers, text):
    """Ids of a whole text by both tokenizers, unless their bytes aren't those of the text."""
    if not text:
        return [], []
    a, b = tokenizers.tokenizer.encode(" " + text, add_special_tokens=False).ids, tokenizers.second.model.encode(text)
    for ids, side in ((a, tokenizers.first), (b, tokenizers.second)):
        if b"".join(side.pieces[i].as_py() for i in ids) != (" " + text).encode():
            return [], []
    return a, b


def brute_force(tokenizers, rows):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids = direct(tokenizers, text)
        ends = []
        for side, tokens in zip((tokenizers.first, tokenizers.second), ids):
            at, of = 0, {}
            for i in tokens:
                at += len(side.pieces[i].as_py())
                of.setdefault(at, []).append(i)
            ends.append(of)
        groups, parts = [], ([], [])
        for at in sorted(set(ends[0]) | set(ends[1])):
            for part, of in zip(parts, ends):
                part += of.get(at, [])
            if at in ends[0] and at in ends[1]:
                groups.append(parts)
                parts = ([], [])
        links = [(x, y) for a, b in groups for x in a for y in b]
        counts.update(set(links))
        docs.append((doc_id, ids, groups, links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc_id, ids, groups, links in docs:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, len(ids[0]), len(ids[1]), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def found(spark, rows, **more):
    return sorted(map(tuple, alignment.align(spark.createDataFrame(rows, SCHEMA), **more).collect()), key=str)


def texts(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES[:draw.choice([9, 26, 27])]) for _ in range(draw.choice([1, 3, 8, 60]))) for _ in range(n)]


def test_tokens_of_spans_are_those_of_the_text(tokenizers):
    for text in texts(1, 1500):
        cut = alignment.spans(text)
        assert "".join(" " + s for s in cut) == " " + text
        a, b = tokenizers.ids(cut)
        assert a.flatten().to_pylist() == tokenizers.tokenizer.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:
            assert b.flatten().to_pylist() == tokenizers.second.model.encode(text)


def test_all_documents_have_the_tokens_of_the_library(spark, tokenizers):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    for text in (r.text for r in rows if r.text):
        a, _ = tokenizers.ids(alignment.spans(text))
        assert a.flatten().to_pylist() == tokenizers.tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_no_piece_runs_on_over_a_space_behind_a_word(tokenizers):
    for side in (tokenizers.first, tokenizers.second):
        assert not [p for p in side.pieces.to_pylist() if re.search(r"\S ", p.decode(errors="replace"))]


def test_spans_are_forgotten():
    paths = alignment.first_path(), alignment.second_path()
    few, many = alignment.Known(paths, kept_chars=50), alignment.Known(paths)
    for text in texts(2, 60):
        cut = list(dict.fromkeys(alignment.spans(text)))
        a, b = few.numbers(cut), many.numbers(cut)
        assert few.chars <= max(50, len(text)) and len(few.codes) == few.sizes.sum() == few.sizes[:len(few.places)].sum()
        assert few.texts.take(a).to_pylist() == many.texts.take(b).to_pylist()
        assert [few.__dict__[n][a].tolist() for n in few.NUMBERS] == [many.__dict__[n][b].tolist() for n in many.NUMBERS]


@pytest.mark.parametrize("sheet_chars, run_chars, many", [(32_000_000, 4_000_000, 64), (300, 120, 1), (1, 1, 3)])
def test_against_the_definition(spark, tokenizers, monkeypatch, sheet_chars, run_chars, many):
    rows = list(enumerate(texts(sheet_chars, 150) + ["the same words again and again"] * 20))
    source = ("RUN_CHARS", run_chars), ("MANY_LINKS", many)
    given = spark.createDataFrame(rows, SCHEMA)

    def small(batches):
        for name, value in source:
            setattr(alignment, name, value)
        return alignment._sheets(batches, (alignment.first_path(), alignment.second_path()), sheet_chars)

    want = brute_force(tokenizers, rows)
    assert found(spark, rows, sheet_chars=sheet_chars) == want
    for name, value in source:
        monkeypatch.setattr(alignment, name, value)
    parts = given.mapInPandas(small, alignment.FIELDS)
    assert sorted(r.doc_id for r in parts.where("code is null").collect()) == [r[0] for r in rows]
    docs = {r[0]: r for r in want}
    for r in parts.where("code is null").collect():
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (*docs[r.doc_id][1:5], docs[r.doc_id][7])


def test_very_long_texts(spark, tokenizers):
    """Texts of which one span is all, and groups of very many tokens."""
    rows = [(1, "x" * 20000), (2, "日本" * 8000), (3, " " * 5000 + "y"), (4, "\n" * 3000), (5, "ab12" * 9000), (6, "word " * 30000)]
    assert found(spark, rows) == brute_force(tokenizers, rows)


def test_defined_cases(spark, tokenizers):
    rows = [(1, None), (2, ""), (3, " "), (4, "a ▁ b"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (5, "Alpha"), (6, "alpha ")]
    assert found(spark, rows) == brute_force(tokenizers, rows)
    assert found(spark, []) == []
    given = spark.createDataFrame([(1, "one two", 5, "x")], SCHEMA + ", sheet int, code string")
    assert alignment.align(given).collect()[0].n_groups == brute_force(tokenizers, [(1, "one two")])[0][3]
