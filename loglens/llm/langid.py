"""Language identification, words first.

A word met in training is scored by its log frequency in each language. An unknown word backs off: each of its
character four-grams counts by its log frequency if it is known, else the three-gram that ends there, and so on down
to single characters. A text's language has the highest mean score; the score is its share after normalisation.

Training takes labelled documents, at most about DOCS_PER_LANGUAGE of each language, chosen by a hash; words seen
only once there are taken as unknown, so that the character grams stand for what new words look like.

Defined cases: a null text or one without a letter is ``und`` with score 0. Without any labelled documents every
text is ``und``. Rows that repeat a doc_id are judged each by its own text; a row without doc_id is neither learned
from nor held out. An empty table gives no rows. Columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loglens.llm.common import mix64, on_executors, runs
from loglens.session import Staging, join_checked

DOCS_PER_LANGUAGE = 2_000
LONGEST_GRAM = 4
LEAST_WORD_COUNT = 2
# Words of a text beyond so many don't make the score any surer.
SURE_WORDS = 12
# Memory for words met by one Python worker, about; beyond that it starts over.
CACHED_BYTES = 128 << 20
# What an entry takes beside its characters and scores.
ENTRY_BYTES = 200
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3


def training_rows(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(lang, text) to learn from: labelled, not held out, at most about so many of a language."""
    usable = docs.where((remainder() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    many = usable.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_many"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return (join_checked(usable.withColumn("_lang", F.col("lang")), many, "_lang")
            .where(place * F.col("_many") < docs_per_language).select("lang", "text"))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in runs(batches):
        for lang, texts in rows.groupby("lang")["text"]:
            counts = Counter(word for text in texts for word in _WORD.findall(text.lower()))
            yield pd.DataFrame({"lang": lang, "word": list(counts), "n": list(counts.values())})


def grams(word: str) -> list[list[str]]:
    """At each place of the marked word, the grams that end there, longest first."""
    marked = f"^{word}$"
    return [[marked[max(0, end - n):end] for n in range(min(LONGEST_GRAM, end), 0, -1)] for end in range(2, len(marked) + 1)]


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(batch["lang"], batch["word"], batch["n"].tolist()):
            for ending in grams(word):
                for gram in ending:
                    counts[lang, gram] += n
        yield pd.DataFrame([(lang, gram, n) for (lang, gram), n in counts.items()], columns=["lang", "gram", "n"])


def learn(rows: DataFrame) -> dict:
    """Word and gram tables of ``rows`` (lang, text), small as the rows are: a bounded sample."""
    staging = Staging(rows.sparkSession)
    words = on_executors(rows).mapInPandas(_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = staging.table(words, "words")
    of_grams = words.mapInPandas(_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    often = words.groupBy("word").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST_WORD_COUNT).select("word")
    of_words = words.join(often, "word").select("lang", F.col("word").alias("gram"), "n").toPandas()
    languages = sorted(set(of_grams["lang"]))
    tables = {}
    for order, counts in [("word", of_words), *of_grams.groupby(of_grams["gram"].str.len())]:
        wide = counts.pivot_table(index="gram", columns="lang", values="n", aggfunc="sum", fill_value=0).reindex(columns=languages, fill_value=0)
        values = wide.to_numpy(float) + 0.5
        tables[order] = list(wide.index), np.log(values / values.sum(axis=0)).astype(np.float32)
    return {"languages": languages, "tables": tables}


def gram_keys(codes: np.ndarray) -> list[np.ndarray]:
    """For each length, a 64-bit key of the gram that ends at each of ``codes``; it means something from that length on."""
    keys, before = [], np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST_GRAM + 1):
        now = mix64(before + codes + np.uint64(n))
        keys.append(now)
        before = np.concatenate([now[:1], now[:-1]])
    return keys


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class WordScores(dict):
    """Row of ``scores`` of each word, filled as words come."""

    def __init__(self, model: dict):
        tables = model["tables"]
        self.known = {word: row for row, word in enumerate(tables["word"][0])} if "word" in tables else {}
        self.known_scores = tables["word"][1] if "word" in tables else None
        self.grams = {order: self._sorted(*table) for order, table in tables.items() if order != "word"}
        self.languages = model["languages"]
        self.start_over()

    @staticmethod
    def _sorted(grams: list[str], scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(grams[0])
        keys = gram_keys(_codes("".join(grams)))[n - 1][n - 1::n]
        order = np.argsort(keys)
        return keys[order], scores[order]

    def start_over(self) -> None:
        self.clear()
        self.held = 0
        self.scores = np.zeros((0, len(self.languages)), np.float32)

    def back_off(self, words: list[str]) -> np.ndarray:
        """Of each word the mean over its places of the longest gram known there."""
        total, found = np.zeros((len(words), len(self.languages))), np.zeros(len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
        word = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        keys = gram_keys(_codes("".join(f"^{w}$" for w in words)))
        left = np.flatnonzero(place > 0)
        for n in range(LONGEST_GRAM, 0, -1):
            if n not in self.grams:
                continue
            table, scores = self.grams[n]
            asked = keys[n - 1][left]
            at = np.minimum(np.searchsorted(table, asked), len(table) - 1)
            hit = (table[at] == asked) & (place[left] >= n - 1)
            of, at = word[left[hit]], at[hit]
            found += np.bincount(of, minlength=len(words))
            for language in range(len(self.languages)):
                total[:, language] += np.bincount(of, scores[at, language], len(words))
            left = left[~hit]
        return (total / np.maximum(found, 1)[:, None]).astype(np.float32)

    def learn(self, words: set[str]) -> None:
        """Have rows for all of ``words``."""
        if self.held > CACHED_BYTES:
            self.start_over()
        new = list(words - self.keys())
        at = [self.known.get(w) for w in new]
        known = [w for w, row in zip(new, at) if row is not None]
        unknown = [w for w, row in zip(new, at) if row is None]
        parts = [self.scores]
        if known:
            parts.append(self.known_scores[[row for row in at if row is not None]])
        if unknown:
            parts.append(self.back_off(unknown))
        self.update(zip([*known, *unknown], range(len(self), len(self) + len(new))))
        self.scores = np.concatenate(parts)
        self.held += sum(4 * len(w) for w in new) + len(new) * (ENTRY_BYTES + 4 * len(self.languages))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        cut = [_WORD.findall(text.lower()) for text in texts]
        distinct = set().union(*cut)
        lettered = None
        if not all(map(str.isalpha, distinct)):             # words may be numbers of other scripts
            lettered = {w for w in distinct if any(map(str.isalpha, w))}
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        judged = lengths > 0 if lettered is None else np.array([not lettered.isdisjoint(words) for words in cut], bool)
        judged &= bool(self.languages)
        names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if not judged.any():
            return names.tolist(), scores
        self.learn(distinct)
        rows = np.fromiter((row for words in cut for row in map(self.__getitem__, words)), np.int64, int(lengths.sum()))
        full = lengths > 0
        starts, means = (np.cumsum(lengths) - lengths)[full], np.zeros((len(texts), len(self.languages)))
        for language in range(len(self.languages)):
            means[full, language] = np.add.reduceat(self.scores[rows, language].astype(np.float64), starts)
        means /= np.maximum(lengths, 1)[:, None]
        share = np.exp((means - means.max(axis=1, keepdims=True)) * np.minimum(lengths, SURE_WORDS)[:, None])
        best = means.argmax(axis=1)
        names[judged] = np.array(self.languages, object)[best[judged]]
        scores[judged] = (share[np.arange(len(texts)), best] / share.sum(axis=1))[judged]
        return names.tolist(), scores


def _predicted(batches: Iterator[pd.DataFrame], model) -> Iterator[pd.DataFrame]:
    words = WordScores(model.value)
    for rows in runs(batches):
        names, scores = words.predict(rows["text"].tolist())
        yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").array, "held_out": rows["held_out"].to_numpy(),
                            "lang_pred": names, "score": scores})


def identify(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each of ``docs`` (doc_id, text, lang)."""
    model = docs.sparkSession.sparkContext.broadcast(learn(training_rows(docs, docs_per_language)))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                        F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"))
    return texts.mapInPandas(lambda batches: _predicted(batches, model), "doc_id long, held_out boolean, lang_pred string, score double")
