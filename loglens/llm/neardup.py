"""MinHash near-duplicates with tensored banding.

The set of a document is its distinct two-word shingles. Two small collections of ``M`` half keys, each made of
``ROWS`` minhashes, are combined pair by pair into the keys of ``M * M`` tables: 2 * M * ROWS minhashes serve
tables that would take M * M * 2 * ROWS of their own. Documents that share a key of any table are candidates;
they are linked only if their full sets are similar enough, and linked documents form components.

At a similarity of exactly 0.8, the chance that no table holds a pair is 2 * (1 - 0.8^2)^10, below 1e-4, and it
vanishes quickly above.

Documents of a large group of copies are not compared pair by pair. In each of a few rounds a document meets one
drawn member of each of its buckets, the most promising of these are compared with it, and components grow; rounds go
on while they link documents. Those that still share a bucket across components then go through an exact prefix
filter: their shingles are ordered by rarity, and only pairs that share an early enough one are compared. Equal sets
are one node from the start.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; a text of
one word is that word. Rows that repeat a doc_id are judged each by its own text. Rows without doc_id are
linked with nothing: their component_id is null and they are kept. An empty table gives no rows. Columns other
than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loglens.llm.common import mix64, on_executors, runs, small_batches, tidied
from loglens.session import Staging, join_checked

WORDS_PER_SHINGLE = 2
SIMILAR_PERCENT = 80
M = 10
ROWS = 2
# Of 32 two-bit samples of the minhashes, a pair at 0.8 has more than 17 that differ about once in a million.
SAMPLES = 32
MOST_DIFFERING = 17
# Rounds in which each document is compared with its most promising candidates, before all that are left. More follow
# while one in so many pairs proves a link: a document left out of a large component would meet all of its members.
ROUNDS = 3
PAIRS_A_LINK = 100
# Candidates of a document that the rounds after the first compare with it.
CANDIDATES = 4
# Rows of ids, keys or pairs that a task hands on: tables that get ever smaller from round to round don't leave a file in each
# of as many tasks as the first.
TASK_ROWS = 100_000
# Words whose hashes a worker keeps, about two hundred bytes each, and characters of texts that it takes apart at a time.
CACHED_WORDS = 100_000
LONGEST_CACHED = 64
RUN_CHARS = 250_000

# Classes of shingles whose frequencies order a prefix: an array of four megabytes.
RARITY_BITS = 20

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SEEDS = mix64(np.arange(1, 2 * M * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

SIGNATURES = ("doc_id long, n_shingles long, set_high long, set_low long, sketch long, "
              "first_keys array<long>, second_keys array<long>")


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash
        value = xxhash.xxh3_64_intdigest(word.encode())
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def shingle_sets(texts: list[str], hashes: WordHashes, size: int = WORDS_PER_SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    words = [_WORD.findall(lowered(text)) for text in texts]
    flat = np.fromiter((h for w in words for h in map(hashes.__getitem__, w)), np.uint64, sum(map(len, words)))
    rolled = flat.copy()
    for i in range(1, size):
        rolled[:-i or None] = mix64(rolled[:-i or None]) + flat[i:]
    rolled, sets, start = mix64(rolled), [], 0
    for w in words:
        if len(w) >= size:
            sets.append(np.unique(rolled[start:start + len(w) - size + 1]))
        else:                               # the whole sequence is one shingle
            whole = np.array([len(w)] if w else [], np.uint64)
            for h in flat[start:start + len(w)]:
                whole = mix64(whole) + h
            sets.append(mix64(whole))
        start += len(w)
    return sets


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``2 * M * ROWS`` minhashes for each set; no set may be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(_SEEDS), len(sets)), np.uint64)
    for i, seed in enumerate(_SEEDS):
        x = (flat ^ seed) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        out[i] = np.minimum.reduceat(x, starts)
    return out.T


def half_keys(mins: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(mins), 2 * M), np.uint64)
    for row in range(ROWS):
        keys = mix64(keys + mins[:, row::ROWS])
    return keys.view(np.int64)


def sketches(mins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mins), np.uint64)
    for i in range(SAMPLES):
        out |= (mins[:, i] >> np.uint64(40) & np.uint64(3)) << np.uint64(2 * i)
    return out.view(np.int64)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import xxhash
    hashes = WordHashes()
    for rows in runs(batches, chars=RUN_CHARS):
        sets = shingle_sets(rows["text"].tolist(), hashes)
        digests = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8") for s in sets]).astype(np.int64)
        full = [i for i, s in enumerate(sets) if len(s)]
        first = second = [None] * len(sets)
        sketch = np.zeros(len(sets), np.int64)
        if full:
            mins = minhashes([sets[i] for i in full])
            keys, first, second = half_keys(mins), list(first), list(second)
            sketch[full] = sketches(mins)
            for row, i in enumerate(full):
                first[i], second[i] = keys[row, :M], keys[row, M:]
        yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").array, "n_shingles": [len(s) for s in sets],
                            "set_high": digests[:, 0], "set_low": digests[:, 1], "sketch": sketch,
                            "first_keys": first, "second_keys": second})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for rows in runs(batches, chars=RUN_CHARS):
        sets = shingle_sets(rows["text"].tolist(), hashes)
        yield pd.DataFrame({"id": rows["id"].array, "shingles": [s.tobytes() for s in sets]})


def _similar(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = []
        for a, b in zip(batch["a_shingles"], batch["b_shingles"]):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        yield batch.loc[keep, ["a", "b"]]


class Confirmer:
    """Compares full sets. A document's set is made once, when a pair first asks for it."""

    def __init__(self, docs: DataFrame, staging: Staging, percent: int):
        self.docs, self.staging, self.percent = docs, staging, percent
        self.sets, self.calls = None, 0

    def ask(self, ids: DataFrame) -> None:
        """Have the sets of ``ids`` (id) at hand."""
        self.calls += 1
        if self.sets is not None:
            ids = ids.join(self.sets.select("id"), "id", "left_anti")
        ids = self.staging.table(ids, f"asked-{self.calls}")
        if self.sets is None or ids.limit(1).count():
            made = join_checked(self.docs, ids, "id", "left_semi").mapInPandas(lambda batches: tidied(_sets(batches)), "id long, shingles binary")
            made = self.staging.table(made, f"sets-{self.calls}")
            self.sets = made if self.sets is None else self.sets.unionByName(made)
        self.staging.drop(f"asked-{self.calls}")

    def links(self, pairs: DataFrame, asked: bool = False) -> DataFrame:
        """Those of ``pairs`` (a, b) whose sets are similar; ``asked`` says that all their sets are at hand."""
        if not asked:
            self.ask(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        both = (pairs.join(self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("b_shingles")), "b")
                .join(self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("a_shingles")), "a"))
        percent = self.percent
        return self.staging.table(both.mapInPandas(lambda batches: tidied(_similar(batches, percent)), "a long, b long"), f"links-{self.calls}")


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has about ``rows`` rows, in no more tasks than these call for, but enough for all cores."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS + 1))


def components(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(id, component_id) of all ids of ``links`` (a, b) that aren't their component's smallest.

    Large and small stars in turn: every node passes its smallest neighbour on to its larger, then to its smaller
    neighbours, until each points at the smallest of its component.
    """
    def large(edges: DataFrame) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b")

    def small(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("b").agg(F.min("a").alias("least"))
        moved = edges.join(least, "b")
        return moved.select(F.col("least").alias("a"), F.col("a").alias("b")).where("a < b").unionByName(
            least.select(F.col("least").alias("a"), "b"))

    def digest(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    rows = links.count()
    edges, step = staging.table(in_tasks(links.where("a < b").select("a", "b").distinct(), rows), f"{name}-0"), 0
    seen = digest(edges)
    while seen[0]:
        step += 1
        rows = 2 * seen[0]
        moved = in_tasks(small(in_tasks(large(edges), rows)), rows).distinct()
        edges = staging.table(in_tasks(moved, rows), f"{name}-{step}")
        staging.drop(f"{name}-{step - 1}")
        before, seen = seen, digest(edges)
        if before == seen:
            break
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component_id"))


def grown(found: DataFrame | None, links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(id, component_id) of all ids that aren't their component's smallest, once ``links`` (a, b) joined those ``found`` so far.

    Only components that a link joins are looked at again, each as one node: its smallest id.
    """
    if found is not None:
        rows = links.count()
        for end in ("a", "b"):
            known = found.select(F.col("id").alias(end), "component_id")
            links = links.join(known, end, "left").withColumn(end, F.coalesce("component_id", end)).drop("component_id")
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = staging.table(in_tasks(links, rows), f"{name}-joined")
    moved = components(links, staging, name)
    if found is None:
        return moved
    into = moved.select(F.col("id").alias("component_id"), F.col("component_id").alias("into"))
    again = join_checked(found, into, "component_id", "left").select("id", F.coalesce("into", "component_id").alias("component_id"))
    again = again.unionByName(moved)
    return staging.table(in_tasks(again, again.count()), f"{name}-all")


def _grouped(nodes: DataFrame, found: DataFrame | None) -> DataFrame:
    """(id, n, sketch, group): the component that each node belongs to so far."""
    known = nodes.select("id", "n", "sketch")
    if found is None:
        return known.withColumn("group", F.col("id"))
    return known.join(found, "id", "left").withColumn("group", F.coalesce("component_id", "id")).drop("component_id")


def _differing() -> Column:
    """How many two-bit samples of two sketches differ."""
    return F.expr("bit_count(((sketch ^ a_sketch) | shiftrightunsigned(sketch ^ a_sketch, 1)) & 6148914691236517205L)")


def _may_be_similar(percent: int) -> Column:
    return ((F.col("group") != F.col("a_group")) & (100 * F.least("n", "a_n") >= percent * F.greatest("n", "a_n"))
            & (_differing() <= MOST_DIFFERING))


def _best_pairs(state: DataFrame, round_: int, percent: int, candidates: int) -> DataFrame:
    """For each member of a bucket of several components, the most promising of one other member of each of its buckets.

    The other is drawn by a hash, so a document of many buckets meets many others. These are dealt into as many classes as
    ``candidates`` are wanted, and the most promising of each is taken.
    """
    drawn = F.struct(F.xxhash64("key", "id", F.lit(round_)).alias("draw"), F.col("id").alias("a"), F.col("n").alias("a_n"),
                     F.col("sketch").alias("a_sketch"), F.col("group").alias("a_group"))
    others = state.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.min(drawn).alias("other"))
    others = others.where("low <> high").select("key", "other.*")
    met = state.join(others, "key").where(_may_be_similar(percent)).select("id", "a", _differing().alias("differ"))
    class_ = F.pmod(F.xxhash64("a", F.lit(round_)), F.lit(candidates))
    best = met.groupBy("id").agg(*(F.min(F.when(class_ == i, F.struct("differ", "a"))).alias(f"best_{i}") for i in range(candidates)))
    best = best.select("id", F.explode(F.array(*(f"best_{i}.a" for i in range(candidates)))).alias("a")).where("a is not null")
    return best.select(F.least("id", "a").alias("a"), F.greatest("id", "a").alias("b")).distinct()


def _counted_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    for batch in batches:
        for shingles in batch["shingles"]:
            np.add.at(counts, np.frombuffer(shingles, np.uint64) >> np.uint64(64 - RARITY_BITS), 1)
    yield pd.DataFrame({"part": range(len(counts) // 4096), "counts": [c.tobytes() for c in counts.reshape(-1, 4096)]})


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(c, np.int64) for c in parts["counts"]], axis=0)
    return pd.DataFrame({"part": parts["part"].head(1), "counts": [np.minimum(total, 2**31 - 1).astype("<i4").tobytes()]})


def rarity(sets: DataFrame) -> np.ndarray:
    """How many shingles of ``sets`` fall into each of 2 ** RARITY_BITS classes: an array of fixed size."""
    kind = "part int, counts binary"
    parts = sets.mapInPandas(lambda batches: tidied(_counted_shingles(batches)), kind).groupBy("part").applyInPandas(_summed, kind).collect()
    return np.concatenate([np.frombuffer(r["counts"], "<i4") for r in sorted(parts, key=lambda r: r["part"])] or [np.zeros(1 << RARITY_BITS, "<i4")])


def _prefixes(batches: Iterator[pd.DataFrame], counts, percent: int) -> Iterator[pd.DataFrame]:
    """The shingles of each set, in order of rarity, one of which any similar set must have among its own first."""
    for batch in batches:
        for doc_id, shingles in zip(batch["id"].tolist(), batch["shingles"]):
            shingles = np.frombuffer(shingles, np.uint64)
            n = len(shingles) + (-len(shingles) * percent) // 100 + 1
            seen = counts.value[shingles >> np.uint64(64 - RARITY_BITS)]
            first = shingles[np.lexsort((shingles, seen))[:n]]
            keys = first.view(np.int64)
            yield pd.DataFrame({"key": keys, "id": doc_id, "place": np.arange(len(keys), dtype=np.int32), "before": np.append([0], keys[:-1])})


def _all_pairs(sets: DataFrame, grouped: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """All pairs of ``sets`` in different components that can be similar by a prefix filter, which loses none.

    If sets are similar, the first shingle they share leaves enough behind it in both. Under a shingle, members of
    its most frequent component are compared with the others only.
    """
    counts = sets.sparkSession.sparkContext.broadcast(rarity(sets))
    prefixes = sets.mapInPandas(lambda batches: tidied(_prefixes(batches, counts, percent)), "key long, id long, place int, before long")
    rows = staging.table(prefixes.join(grouped, "id"), "prefixes")
    frequent = (rows.groupBy("key", "group").agg(F.count("*").alias("many")).groupBy("key")
                .agg(F.count("*").alias("kinds"), F.max(F.struct("many", "group")).alias("most")).where("kinds > 1")
                .select("key", F.col("most.group").alias("major")))
    rows = rows.join(frequent, "key")
    few = rows.where("group <> major").select("key", *(F.col(c).alias(f"a_{c}") for c in ("id", "place", "before", "n", "sketch", "group")))
    enough = (100 + percent) * F.least(F.col("n") - F.col("place"), F.col("a_n") - F.col("a_place")) >= percent * (F.col("n") + F.col("a_n"))
    again = (F.col("place") > 0) & (F.col("a_place") > 0) & (F.col("before") == F.col("a_before"))   # met one shingle earlier
    pairs = few.join(rows, "key").where(
        _may_be_similar(percent) & enough & ~again & ((F.col("group") == F.col("major")) | (F.col("a_id") < F.col("id"))))
    return pairs.select(F.least("a_id", "id").alias("a"), F.greatest("a_id", "id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each of ``docs`` (doc_id, text)."""
    staging = Staging(docs.sparkSession)
    small_batches(docs.sparkSession)
    texts = on_executors(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signatures = staging.table(texts.mapInPandas(lambda batches: tidied(_signatures(batches)), SIGNATURES), "signatures")
    nodes = staging.table(
        signatures.where("n_shingles > 0 and doc_id is not null").groupBy("set_high", "set_low").agg(
            F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"),
            *(F.first(c).alias(c) for c in ("sketch", "first_keys", "second_keys"))), "nodes")
    table = F.explode(F.sequence(F.lit(0), F.lit(M * M - 1)))
    keys = nodes.select("id", "first_keys", "second_keys", table.alias("t")).select(
        F.xxhash64("t", F.expr(f"first_keys[t div {M}]"), F.expr(f"second_keys[t % {M}]")).alias("key"), "id")
    buckets = staging.table(keys.groupBy("key").agg(F.count("*").alias("many")).where("many > 1").select("key"), "buckets")
    members = staging.table(join_checked(keys, buckets, "key", "left_semi"), "members")
    confirmer = Confirmer(texts.select(F.col("doc_id").alias("id"), "text"), staging, percent)
    found, holds_found, round_, growing = None, 0, 0, ROUNDS > 0
    while size := members.count():
        last = round_ >= ROUNDS and not growing
        round_ += 1
        grouped = _grouped(nodes, found)
        if last:
            confirmer.ask(members.select("id").distinct())
            pairs = _all_pairs(confirmer.sets, grouped, percent, staging)
        else:
            pairs = _best_pairs(in_tasks(members.join(grouped, "id"), size), round_, percent, CANDIDATES if round_ > 1 else 1)
            pairs = in_tasks(pairs, size)
        pairs = staging.table(pairs, f"round-{round_}/pairs")
        new = confirmer.links(pairs, asked=last)
        linked = new.count()
        growing = PAIRS_A_LINK * linked > pairs.count()
        if linked:
            found, holds_found = grown(found, new, staging, f"round-{round_}/components"), round_
        elif not last:
            round_ = max(round_, ROUNDS)    # only the complete round is left
        if last:
            break
        mixed = members.join(_grouped(nodes, found), "id").groupBy("key").agg(
            F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("key")
        members = staging.table(in_tasks(members.join(mixed, "key", "left_semi"), size), f"round-{round_}/members")
        for done in set(range(1, round_)) - {holds_found}:
            staging.drop(f"round-{done}")
    for done in ("buckets", "members", "prefixes", *(f"sets-{i + 1}" for i in range(confirmer.calls)),
                 *(f"round-{i + 1}" for i in range(round_) if i + 1 != holds_found)):
        staging.drop(done)
    groups = nodes.select("set_high", "set_low", "id", "copies")
    groups = (groups.join(found, "id", "left") if found is not None else groups.withColumn("component_id", F.lit(None).cast("long")))
    groups = groups.where("copies > 1 or component_id is not null").select(
        "set_high", "set_low", F.coalesce("component_id", "id").alias("component_id"))
    result = signatures.select("doc_id", "n_shingles", "set_high", "set_low").join(groups, ["set_high", "set_low"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), F.col("doc_id")))
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         (component.isNull() | (F.col("doc_id") == component)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Those of ``docs`` (doc_id, text, others) that no component of smaller doc_id takes in. Rows of a repeated doc_id go
    together, if any of them goes.

    Only the ids of what goes are joined to the texts.
    """
    gone = near_duplicates(docs.select("doc_id", "text")).where(~F.col("kept")).select("doc_id").distinct()
    return join_checked(docs, gone, "doc_id", "left_anti")
