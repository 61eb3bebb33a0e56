"""Packing against the tokenizer itself, and its bins by hand."""

import random
import zlib

import numpy as np
import pytest
from loglens.llm import packing

SCHEMA = "doc_id long, text string"
TEXTS = [(1, "The cat sat on the mat."), (2, None), (3, ""), (4, "It's 12.5% of <|endoftext|> a|b | c\n\ttabs  and spaces"),
         (5, "naïve CAFÉ ﬁ Ǆ Σ ΑΣ " * 40), (5, "again"), (None, "no id"), (6, "word " * 700), (7, "x" * 3000)]


@pytest.fixture(scope="module")
def tokens():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_pieces_are_the_tokenizers_ids(spark, tokens):
    rows = packing.token_pieces(spark.createDataFrame(TEXTS, SCHEMA), packing.tokenizer_path(), capacity=50).collect()
    expected = []
    for doc_id, text in TEXTS:
        ids = tokens(text)
        for at in range(0, len(ids), 50):
            part = np.array(ids[at:at + 50], "<u4")
            expected.append((doc_id, at // 50, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, rows)) == sorted(str(type(rows[0])(**dict(zip(rows[0].asDict(), e)))) for e in expected)


@pytest.mark.parametrize("open_bins", [1, 3, 1000])
def test_sequences_are_gapless_and_whole(spark, tokens, open_bins):
    docs = spark.createDataFrame([(*row, "other") for row in TEXTS], SCHEMA + ", sequence_id string")
    rows = packing.pack_documents(docs, capacity=60, open_bins=open_bins, tokens_per_task=300).collect()
    assert sum(r.length for r in rows) == sum(len(tokens(text)) for _, text in TEXTS)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 60


def test_best_fit_takes_the_fullest_bin_that_fits_and_closes_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)          # three fit exactly there
    assert bins.place(4) == (0, 6) and bins.open == 0
    assert bins.place(8) == (2, 0) and bins.place(5) == (3, 0)
    assert bins.place(6) == (4, 0)          # a third open bin: the one with two left is closed
    assert bins.open == 2 and bins.place(2) == (4, 6)


def test_ids_of_odd_words(tokens):
    draw = random.Random(6)
    signs = "—“”…«aZÀéßİıſǅΣσςΑ'.,-½²٣ЖЙ字カe\u0301=\u0338'sre'llVE0|<>\u00ad\u200d\t\r\u00a0\u2028😀_"
    words = packing.WordIds(packing.tokenizer_path())
    texts = ["".join(draw.choice(signs + "   ") for _ in range(draw.randrange(60))) for _ in range(3000)]
    for text, ids in zip(texts, words.texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokens(text)[:-1], text


def test_texts_without_spaces_are_not_kept_for_good(tokens, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 100_000)
    words = packing.WordIds(packing.tokenizer_path())
    for i in range(20):
        text = ("base64/" if i % 2 else "漢字") * 3_000 + str(i)
        assert np.frombuffer(words.texts([text])[0], "<u4").tolist() == tokens(text)[:-1]
        assert words.held < 100_000 + 20 * len(text)


def test_no_rows(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []
