"""Ranked lexical search: the highest-scoring documents of each query item.

Documents are cut to the terms that some item asks for: a row of term numbers and frequencies each. A task reads such
rows in chunks, and over a chunk keeps a posting list for each term, sorted by document, with the weight that each
posting adds to a score. Sparse tables give the maximum of any range of a list in two look-ups.

An item's search of a chunk starts with the interval of all documents. An interval's bound is the sum, over the item's
terms, of the maximum of the term's postings in it. The intervals with the highest bounds come first. One is split
at the document that holds the largest of its maxima: this document gets its score, what lies before and behind it are
new intervals with bounds of their own. An interval that can't beat the item's worst kept document any more is dropped, one of
few postings is scored whole. So a chunk gives its ``k`` best documents exactly, and the best of all chunks are
the answer. Items are searched for side by side, each with its own order, so that numpy works on long arrays.

Items are taken in blocks of bounded size, and the terms of one block are sent to the tasks; each block is a pass over the texts.

Defined cases: a null or empty text has no terms; such an item has no answer and such a document is none. Rows that
repeat an item_id or doc_id are items or documents of their own. Documents without doc_id come last among equal scores.
Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from loglens.llm.common import on_executors, runs
from loglens.session import Staging

BEST = 20
# Characters of items whose terms are sent to tasks together.
BLOCK_CHARS = 4_000_000
# Postings of a chunk: about 100 MB with their sparse tables.
CHUNK_POSTINGS = 1_000_000
# Postings of the lists of items that are searched for side by side.
SIDE_BY_SIDE = 2_000_000
# Intervals of each item that are split in one step.
WIDTH = 32
# Intervals of so few postings are scored whole.
FEW = 128

# Of the bytes of a text those of terms, A-Z lower-cased; all others become spaces. Bytes of other characters are over 127.
_TERM_BYTES = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b > 127 else 32 for b in range(256))
NO_DOC = np.iinfo(np.int64).max


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of letters, digits and all characters beyond ASCII."""
    return text.encode().translate(_TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Items:
    """A block of items: numbers of all terms, and of each item its terms with how often it has them."""

    rows: list[int]
    numbers: dict[bytes, int]
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[int], texts: list[str]) -> Items:
        numbers: dict[bytes, int] = {}
        terms, times = [], []
        for text in texts:
            counted = Counter(terms_of(text))
            terms.append(np.array([numbers.setdefault(t, len(numbers)) for t in counted], np.int64))
            times.append(np.array(list(counted.values()), np.int64))
        return cls(rows, numbers, terms, times)


def _postings(batches: Iterator[pd.DataFrame], items) -> Iterator[pd.DataFrame]:
    """Of each document its number of terms, and the numbers and frequencies of those asked for."""
    get, size = items.value.numbers.get, len(items.value.numbers)
    for rows in runs(batches):
        found = [terms_of(text) for text in rows["text"]]
        n = np.array([len(t) for t in found], np.int64)
        flat = np.fromiter(map(get, chain.from_iterable(found), repeat(-1)), np.int64, int(n.sum()))
        keys = np.repeat(np.arange(len(n)), n) * size + flat
        keys, tf = np.unique(keys[flat >= 0], return_counts=True)
        ends = np.searchsorted(keys, np.arange(1, len(n) + 1) * size)
        terms, tf = (keys % max(size, 1)).astype("<i4"), tf.astype("<i4")
        cut = [slice(a, b) for a, b in zip([0, *ends[:-1]], ends)]
        yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").array, "n": n, "terms": [terms[c].tobytes() for c in cut],
                            "tf": [tf[c].tobytes() for c in cut]})


def _holding(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch["terms"]), "<i4"), minlength=size)
    terms = np.flatnonzero(total)
    yield pd.DataFrame({"term": terms, "df": total[terms]})


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of slices that begin at ``first``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Chunk:
    """Posting lists of some documents and the sparse tables over them. Documents are numbered by ascending doc_id."""

    def __init__(self, rows: pd.DataFrame, weights: np.ndarray, documents: int, total: int):
        rows = rows.sort_values("doc_id", na_position="last", kind="stable")
        self.doc_ids = rows["doc_id"].astype("Int64").array
        self.size = len(rows)
        terms, tf = (np.frombuffer(b"".join(rows[c]), "<i4").astype(np.int64) for c in ("terms", "tf"))
        docs = np.repeat(np.arange(self.size), rows["terms"].str.len().to_numpy() // 4)
        length = 75 + (25 * rows["n"].to_numpy() * documents) // max(total, 1)
        order = np.argsort(terms * self.size + docs)
        terms, self.docs, tf = terms[order], docs[order], tf[order]
        self.keys = terms * self.size + self.docs
        self.adds = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length[self.docs]))
        self.starts = np.searchsorted(self.keys, np.arange(len(weights) + 1) * self.size)
        longest = int(np.diff(self.starts).max(initial=1))
        levels = [np.arange(len(tf), dtype=np.int32)]
        while 1 << len(levels) <= longest:
            half = 1 << (len(levels) - 1)
            left, right = levels[-1][:-half], levels[-1][half:]
            levels.append(np.where(self.adds[right] > self.adds[left], right, left))
        self.table = np.concatenate(levels)
        self.level_starts = np.cumsum([0, *map(len, levels[:-1])])
        self.logs = np.zeros(longest + 1, np.int64)
        for level in range(1, len(levels)):
            self.logs[1 << level:] = level

    def highest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the first maximum of each range [a, b)."""
        level = self.logs[b - a]
        at = self.level_starts[level]
        left, right = self.table[at + a], self.table[at + b - (1 << level)]
        return np.where(self.adds[right] > self.adds[left], right, left)


@dataclass
class Intervals:
    """Intervals of documents: the item of each, its bound, its first document, and the ranges [a, b) of lists in it."""

    item: np.ndarray
    sizes: np.ndarray
    base: np.ndarray
    times: np.ndarray
    a: np.ndarray
    b: np.ndarray
    top: np.ndarray
    bound: np.ndarray
    low: np.ndarray

    @classmethod
    def of(cls, chunk: Chunk, item, owner, base, times, a, b) -> Intervals:
        """From ranges sorted by ``owner``; intervals without a range vanish."""
        kept, sizes = np.unique(owner, return_counts=True)
        at, top = np.cumsum(sizes) - sizes, chunk.highest(a, b)
        if not len(kept):
            return cls(item[:0], sizes, base, times, a, b, top, a[:0], a[:0])
        return cls(item[kept], sizes, base, times, a, b, top, np.add.reduceat(times * chunk.adds[top], at),
                   np.minimum.reduceat(chunk.docs[a], at))

    def __len__(self) -> int:
        return len(self.item)

    def only(self, rows: np.ndarray) -> Intervals:
        at = _ragged((np.cumsum(self.sizes) - self.sizes)[rows], self.sizes[rows])
        return Intervals(self.item[rows], self.sizes[rows], self.base[at], self.times[at], self.a[at], self.b[at], self.top[at],
                         self.bound[rows], self.low[rows])

    def with_(self, other: Intervals) -> Intervals:
        return Intervals(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in self.__dataclass_fields__))


class Kept:
    """The best documents of each item so far."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least, self.worst = least.copy(), np.full(items, NO_DOC)

    def add(self, item, score, doc) -> None:
        keep = score > 0
        item, score, doc = (np.concatenate([old, new[keep]]) for old, new in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.k]
        self.item, self.score, self.doc = item[order], score[order], doc[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        better = self.score[last] >= self.least[self.item[last]]
        last = last[better]
        self.least[self.item[last]], self.worst[self.item[last]] = self.score[last], self.doc[last]

    def may_enter(self, these: Intervals) -> np.ndarray:
        least = self.least[these.item]
        return (these.bound > least) | ((these.bound == least) & (these.low < self.worst[these.item]))


def _scored_whole(chunk: Chunk, few: Intervals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = few.b - few.a
    at = _ragged(few.a, lengths)
    keys = np.repeat(np.repeat(np.arange(len(few)), few.sizes), lengths) * chunk.size + chunk.docs[at]
    keys, which = np.unique(keys, return_inverse=True)
    score = np.zeros(len(keys), np.int64)
    np.add.at(score, which, np.repeat(few.times, lengths) * chunk.adds[at])
    return few.item[keys // chunk.size], score, keys % chunk.size


def _split(chunk: Chunk, these: Intervals) -> tuple[np.ndarray, np.ndarray, Intervals]:
    """Score and number of the document each interval is split at, and the intervals before and behind it."""
    at, n = np.cumsum(these.sizes) - these.sizes, len(these)
    owner = np.repeat(np.arange(n), these.sizes)
    value = these.times * chunk.adds[these.top]
    largest = np.where(value == np.maximum.reduceat(value, at)[owner], np.arange(len(value)), len(value))
    doc = chunk.docs[these.top[np.minimum.reduceat(largest, at)]]
    wanted = these.base + doc[owner]
    place = np.searchsorted(chunk.keys, wanted)
    there = chunk.keys[np.minimum(place, len(chunk.keys) - 1)] == wanted
    score = np.add.reduceat(np.where(there, these.times * chunk.adds[np.minimum(place, len(chunk.adds) - 1)], 0), at)
    before, behind = place > these.a, place + there < these.b
    both = lambda x, y: np.concatenate([x[before], y[behind]])
    return score, doc, Intervals.of(chunk, np.concatenate([these.item, these.item]), both(owner, owner + n), both(these.base, these.base),
                                    both(these.times, these.times), both(these.a, place + there), both(place, these.b))


def search(chunk: Chunk, terms: list[np.ndarray], times: list[np.ndarray], k: int, least: np.ndarray, few: int = FEW) -> Kept:
    """The ``k`` best documents of ``chunk`` for each item that score ``least`` of it or more."""
    kept = Kept(len(terms), k, least)
    sizes = np.array([len(t) for t in terms], np.int64)
    flat, owner = np.concatenate(terms), np.repeat(np.arange(len(terms)), sizes)
    a, b = chunk.starts[flat], chunk.starts[flat + 1]
    some = np.flatnonzero(b > a)
    some = some[chunk.adds[a[some]] > 0]                        # a weight of zero adds nothing anywhere
    waiting = Intervals.of(chunk, np.arange(len(terms)), owner[some], flat[some] * chunk.size, np.concatenate(times)[some], a[some], b[some])
    while len(waiting):
        order = np.lexsort((waiting.low, -waiting.bound, waiting.item))
        place = np.arange(len(order)) - np.searchsorted(waiting.item[order], waiting.item[order])
        first, rest = waiting.only(order[place < WIDTH]), waiting.only(order[place >= WIDTH])
        held = np.add.reduceat(first.b - first.a, np.cumsum(first.sizes) - first.sizes)
        whole, large = first.only(np.flatnonzero(held <= few)), first.only(np.flatnonzero(held > few))
        if len(whole):
            kept.add(*_scored_whole(chunk, whole))
        if len(large):
            score, doc, parts = _split(chunk, large)
            kept.add(large.item, score, doc)
            rest = rest.with_(parts)
        waiting = rest.only(np.flatnonzero(kept.may_enter(rest)))
    return kept


def _groups(items: Items, chunk: Chunk) -> Iterator[slice]:
    """Items whose lists have about SIDE_BY_SIDE postings together."""
    lengths = np.diff(chunk.starts)
    ends, start = np.cumsum([int(lengths[t].sum()) for t in items.terms]), 0
    while start < len(items.terms):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SIDE_BY_SIDE, "right")))
        yield slice(start, stop)
        start = stop


def _answers(batches: Iterator[pd.DataFrame], model, k: int, chunk_postings: int) -> Iterator[pd.DataFrame]:
    items, weights, documents, total = model.value
    least = np.ones(len(items.terms), np.int64)
    waiting, held = [], 0

    def answers() -> pd.DataFrame:
        chunk, out = Chunk(pd.concat(waiting), weights, documents, total), []
        for group in _groups(items, chunk):
            kept = search(chunk, items.terms[group], items.times[group], k, least[group])
            least[group] = np.maximum(least[group], kept.least)     # what an earlier chunk has beaten can't be among the best
            out.append(pd.DataFrame({"row": np.array(items.rows[group])[kept.item], "doc_id": chunk.doc_ids[kept.doc], "score": kept.score}))
        return pd.concat(out)

    for batch in batches:
        ends = held + np.cumsum(batch["terms"].str.len().to_numpy() // 4)
        start = 0
        while start < len(batch):
            stop = int(np.searchsorted(ends, chunk_postings, "right"))
            stop = len(batch) if stop >= len(batch) else max(stop, start if waiting else start + 1)
            waiting.append(batch.iloc[start:stop])
            held, start = int(ends[stop - 1]) if stop else held, stop
            if start < len(batch):
                yield answers()
                ends, held = ends - held, 0
                waiting.clear()
    if waiting:
        yield answers()


def rank(docs: DataFrame, items: DataFrame, k: int = BEST, block_chars: int = BLOCK_CHARS, chunk_postings: int = CHUNK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    work, answer = Staging(spark), Staging(spark)
    texts = on_executors(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    asked = work.table(items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                       .withColumn("row", F.monotonically_increasing_id()), "items")
    chars = asked.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks, found = int(chars // block_chars) + 1, None
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).select("row", "text").collect()
        made = Items.of([r["row"] for r in block], [r["text"] for r in block])
        if not made.numbers:
            continue
        sent = spark.sparkContext.broadcast(made)
        postings = work.table(texts.mapInPandas(lambda batches, sent=sent: _postings(batches, sent), "doc_id long, n long, terms binary, tf binary")
                              .where("n > 0"), f"postings-{number}")
        counted = postings.agg(F.count("*"), F.sum("n")).first()
        size = len(made.numbers)
        weights = np.full(size, weight(counted[0], 0), np.int64)
        for r in (postings.select("terms").mapInPandas(lambda batches, size=size: _holding(batches, size), "term int, df long")
                  .groupBy("term").agg(F.sum("df").alias("df")).collect()):
            weights[r["term"]] = weight(counted[0], r["df"])
        model = spark.sparkContext.broadcast((made, weights, counted[0], counted[1] or 0))
        best = postings.where(F.octet_length("terms") > 0).mapInPandas(
            lambda batches, model=model: _answers(batches, model, k, chunk_postings), "row long, doc_id long, score long")
        best = work.table(best, f"best-{number}")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "row long, doc_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    result = answer.table(asked.select("row", "item_id").join(ranked, "row").select("item_id", "rank", "doc_id", "score"), "result")
    work.drop()
    return result
