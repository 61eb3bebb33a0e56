import hashlib
import random
import re

from pyspark.sql import functions as F
import pytest
import regex

from loglens.functions.text import doc_id, required_matches, similar_to, snippet_tokens, tokenize


def test_words(evaluate):
    cases = {"Jan  4 01:40:25 phsdc-vs2 ADE: |1 NOTICE": ["jan", "4", "01", "40", "25", "phsdc", "vs2", "ade", "1", "notice"],
             "bycast.log won't 25.274618 1,000;2": ["bycast.log", "won't", "25.274618", "1,000;2"],
             "foo_bar _ __ a.1 1.a x: .y": ["foo_bar", "a", "1", "1", "a", "x", "y"], "": [], " -- ": [],
             "中文 ab字cd Ünï": ["中", "文", "ab", "字", "cd", "ünï"], "a\tb\rc d": ["a", "b", "c", "d"]}
    assert dict(zip(cases, evaluate(tokenize, cases))) == cases


def test_long_words_are_cut_and_nothing_recurses(evaluate):
    words, dots, bars, mixed = evaluate(tokenize, ["a1" * 50_000, "." * 100_000, "_" * 100_000, "x" * 255 + " " + "y" * 256])
    assert [len(w) for w in words] == [255] * 392 + [40] and "".join(words) == "a1" * 50_000
    assert dots == [] and bars == [] and [len(w) for w in mixed] == [255, 255, 1]


def _words(text):
    """The same words found the other way round: by what they consist of."""
    text = regex.sub(r"([\p{Han}\p{Hiragana}])", r" \1 ", text).lower()
    found = regex.findall(r"(?:_+|[\p{L}\p{M}]+(?:[.:'’·][\p{L}\p{M}]+)*|\p{N}+(?:[.,;'’]\p{N}+)*)+", text)
    return [w for w in found if regex.search(r"[\p{L}\p{N}]", w)]


def test_words_of_random_texts(evaluate):
    rng = random.Random(7)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))
             for letters in ["a1_.,:;' -", "aB1_.'é·’, \t中"] for _ in range(3000)]
    assert evaluate(tokenize, texts) == [_words(t) for t in texts]


def _similar(line, snippet, pct=75):
    words = _words(snippet)
    return bool(words) and sum(w in set(_words(line)) for w in words) >= max(1, len(words) * pct // 100)


@pytest.mark.parametrize("snippet", ["a b c d", "a a a b", "a", "...", "A.b b", " ".join("abcdefgh"), " ".join(f"w{i}" for i in range(40))])
def test_similar_lines(spark, snippet):
    rng = random.Random(11)
    lines = [" ".join(rng.choice("abcdefgh xyz.") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    lines += ["ab cd", "b A.B", snippet, snippet.upper(), " ".join(f"w{i}" for i in range(30)), " ".join(f"w{i}" for i in range(29))]
    df = spark.createDataFrame([(l,) for l in lines], "message string").withColumn("tokens", tokenize("message"))
    got = df.select(similar_to(spark, snippet).alias("a"), similar_to(spark, snippet, tokens="tokens").alias("b")).collect()
    want = [_similar(l, snippet) for l in lines]
    assert [r.a for r in got] == want and [r.b for r in got] == want


def test_required():
    assert [required_matches(n) for n in (1, 2, 3, 4, 5, 7)] == [1, 1, 2, 3, 3, 5]


def test_snippet_tokens(spark):
    assert snippet_tokens(spark, "The the End") == ["the", "the", "end"]


def test_document_ids(spark):
    rows = spark.createDataFrame([("aaa.txt", 1), ("p" * 509, 3), ("p" * 510, 3)], "relpath string, n long")
    short, edge, long = [r.d for r in rows.select(doc_id("relpath", "n").alias("d")).collect()]
    assert short == "aaa.txt/1" and edge == "p" * 509 + "/3" and len(edge) == 511
    assert long == hashlib.sha256(("p" * 510 + "/3").encode()).hexdigest() and re.fullmatch("[0-9a-f]{64}", long)
