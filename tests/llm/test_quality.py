"""The language model against counts and probabilities computed in Python."""

import math
import random
from collections import Counter

import pytest
from loglens.llm import quality
from loglens.session import Staging

ORDER = 3


def brute_force(texts, order):
    """Probability of a character after a context, by interpolated modified Kneser-Ney."""
    marked = [quality.START * (order - 1) + "".join("0" if c in "0123456789" else c for c in t) for t in texts]
    counts = {order: Counter(t[i - order + 1:i + 1] for t in marked for i in range(order - 1, len(t)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts = {}
    for n, grams in counts.items():
        many = Counter(grams.values())
        n1, n2, n3, n4 = (many[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        discounts[n] = [min(max(d, 0.1), most) for d, most in zip(raw, (0.9, 1.8, 2.7))]
    kinds = len(counts[1]) + 1

    def p(gram):
        if not gram:
            return 1 / kinds
        n = len(gram)
        seen = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not seen:
            return p(gram[1:])
        of = lambda c: discounts[n][min(c, 3) - 1]
        total = sum(seen.values())
        own = (seen[gram] - of(seen[gram])) / total if gram in seen else 0
        return own + sum(map(of, seen.values())) / total * p(gram[1:])

    def bits(text):
        text = quality.START * (order - 1) + "".join("0" if c in "0123456789" else c for c in text)
        return -sum(math.log2(p(text[i - order + 1:i + 1])) for i in range(order - 1, len(text)))
    return bits


def sentences(seed, n):
    draw = random.Random(seed)
    return [" ".join(draw.choice(["the", "then", "on", "été", "ion", "12", "of"]) for _ in range(draw.randrange(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("shard_rows", [1_000_000, 40])
def test_bits_are_those_of_the_counts(spark, shard_rows):
    trusted, others = sentences(1, 40), sentences(2, 10) + ["xyz the q", "", "T", "9 the 7", "x" * 5000]
    staging = Staging(spark)
    model = quality.train(spark.createDataFrame([(t,) for t in trusted], "text string"), ORDER, staging)
    docs = spark.createDataFrame(list(enumerate([*others, None])), "i long, text string")
    found = {r.i: r._bits for r in quality.Scorer(model, staging, ORDER, shard_rows).with_bits(docs).collect()}
    bits = brute_force(trusted, ORDER)
    for i, text in enumerate(others):
        assert found[i] == pytest.approx(bits(text), rel=1e-4, abs=1e-3), text
    assert found[len(others)] == 0


def test_junk_goes_and_clean_text_stays(spark):
    clean = sentences(3, 300)
    junk = [" ".join("%&#" + c for c in t.upper()) for t in sentences(4, 30)]
    rows = [(i, t, "aa") for i, t in enumerate(clean + junk)] + [(900, None, "aa"), (901, "", None), (902, "the then of on", "zz"), (None, "the on", None), (1, clean[1], "aa")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, keep string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 300, 2)] + [(300, 0), (None, 1), (0, 1)], "doc_id long, quality int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == len(rows)
    keep = {r.doc_id: r.keep for r in found}
    assert sum(keep[i] for i in range(300)) >= 285 and not any(keep[i] for i in range(300, 330))
    assert not keep[900] and not keep[901] and keep[902] and keep[None]
    kept = quality.filter_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in found)


def test_without_trusted_documents(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert {r.doc_id: (r.perplexity, r.keep) for r in quality.classify(docs, labels).collect()} == {1: (None, True), 2: (None, False)}
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_texts_come_in_small_batches_and_workers_give_memory_back(spark, monkeypatch):
    from loglens.llm import common
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, "a b " * 500, "x") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    spark.conf.unset(size)
    quality.classify(docs, labels)
    assert spark.conf.get(size) == common.BATCH_BYTES
    sizes = docs.repartition(1).mapInPandas(lambda batches: (b[["doc_id"]].head(1).assign(n=len(b)) for b in batches), "doc_id long, n long")
    spark.conf.set(size, "20k")
    quality.classify(docs, labels)                          # what the session says stays
    assert spark.conf.get(size) == "20k" and max(r.n for r in sizes.collect()) < 20
    spark.conf.unset(size)
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.tidied(iter([1, 2]))) == [1, 2] and given == [1]
