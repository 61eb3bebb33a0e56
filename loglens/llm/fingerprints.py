"""Document fingerprints: digests of statistically improbable features.

Features are windows of WINDOW bytes of a text's UTF-8. The entropy of every window of every document is counted
first; the rarer its entropy is among them, the earlier a window ranks, and a hash of its bytes settles ties. Of each
SPAN neighbouring windows the first in rank gets a point, equal windows of a text together, and those with POINTS
points or more are selected. Where fewer than LEAST are, the first in rank are added. Besides, every text gives the
SHORT_FEATURES windows of SHORT_WINDOW bytes with the smallest hashes, so that short texts can be told apart and texts
of all lengths have a kind in common. Hashes set bits in a chain of Bloom filters, so many features to a filter, short
windows in the last. Two digests are compared filter by filter: common bits beyond what chance gives, relative to the
most there could be; each filter of the shorter chain counts with its best match.

Defined cases: a null text is empty. An empty text has no filter, any other has at least one; it is like another empty
one only. A text of fewer than SHORT_WINDOW bytes is one short window. Neighbours in descending doc_id follow ties by
a hash of the text, and rows without doc_id come first; one document is its own next one. An empty table gives no
rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from loglens.llm.common import mix64, on_executors, runs

WINDOW = 32
SPAN = 64                                   # a power of two
POINTS = 8
LEAST = 16
SHORT_WINDOW = 8
SHORT_FEATURES = 128                        # one filter
FEATURES_PER_FILTER = 128
FILTER_BITS = 2048
BITS_PER_FEATURE = 5
LEVELS = 1000
# Neighbours are found within ranges of ids that hold about so many characters.
RANGE_CHARS = 4_000_000
MOST_RANGES = 10_000

_UNIT = 1 << 16
_C_LOG_C = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 2)], np.int64)
_STEP = np.diff(_C_LOG_C)                   # from c to c + 1 bytes of a kind in a window
_MOST = int(_C_LOG_C[WINDOW])

ROWS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def entropies(data: np.ndarray) -> np.ndarray:
    """Level of entropy, 0 to LEVELS, of the window that begins at each place of ``data`` (bytes); integer throughout."""
    n = len(data)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = data[lag:] == data[:-lag]
        before[lag:] += same
        after[:-lag] += same
    change = _STEP[before]                  # of the sum of c * log c as a byte enters
    change[WINDOW:] -= _STEP[after[:-WINDOW]]
    sums = np.cumsum(change)[WINDOW - 1:]
    return ((_MOST - sums) * LEVELS // _MOST).astype(np.int64)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as bytes; the level of each window; where each text's windows begin, and how many it has."""
    data = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    return data, entropies(data), np.cumsum(lengths) - lengths, np.maximum(lengths - WINDOW + 1, 0)


def _inside(starts: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, counts > 0)
    np.add.at(edges, starts + counts, -(counts > 0).astype(np.int64))
    return np.cumsum(edges)[:size] > 0


def _levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(LEVELS + 1, np.int64)
    for rows in runs(batches):
        _, levels, starts, counts = windows_of([t.encode("utf-8", "surrogatepass") for t in rows["text"]])
        inside = np.concatenate([np.arange(s, s + c) for s, c in zip(starts.tolist(), counts.tolist())] or [np.zeros(0, np.int64)])
        total += np.bincount(levels[inside], minlength=LEVELS + 1)
    yield pd.DataFrame({"level": np.flatnonzero(total), "n": total[total > 0]})


def ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each level of entropy, the rarest first, from a count over all windows of ``docs`` (text)."""
    texts = on_executors(docs).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = texts.mapInPandas(_levels, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(LEVELS + 1, np.int64)
    for row in counted:                     # at most one row a level
        n[row["level"]] = row["n"]
    out = np.empty(LEVELS + 1, np.int64)
    out[np.argsort(n, kind="stable")] = np.arange(LEVELS + 1)
    return out


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_HASH_BITS = 53


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of SHORT_WINDOW bytes and of WINDOW bytes that begin at each place of ``data`` (bytes)."""
    x, width = data.astype(np.uint64), 1
    while width < SHORT_WINDOW:
        x = x[:-width] | x[width:] << np.uint64(8 * width)
        width *= 2
    short = mix64(x * _FACTOR)
    wide = short
    while width < WINDOW:
        wide = mix64(wide[:-width] * _FACTOR + wide[width:])
        width *= 2
    return short, wide


def _least_short(hashes: np.ndarray) -> np.ndarray:
    """The SHORT_FEATURES smallest of ``hashes``, each once."""
    many = 8 * SHORT_FEATURES
    if len(hashes) > many:                  # most can be left out of the sort, unless too few are left
        few = np.unique(hashes[hashes < np.uint64((1 << 64) * (many // 2) // len(hashes))])
        if len(few) >= SHORT_FEATURES:
            return few[:SHORT_FEATURES]
    return np.unique(hashes)[:SHORT_FEATURES]


def _selected(keys: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Of one text's windows, by ``keys``, those selected, by where they first get a point; ``least`` is the first in
    rank of each span."""
    begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]])) if len(least) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(begin, len(least)))
    kinds, first, at = np.unique(least[begin], return_index=True, return_inverse=True)
    chosen = np.bincount(at, lengths, minlength=len(kinds)) >= POINTS
    out = kinds[chosen][np.argsort(first[chosen])]
    if len(out) < LEAST and len(keys):
        ranked = np.unique(keys)
        out = np.concatenate([out, ranked[~np.isin(ranked, out)][:LEAST - len(out)]])
    return out


def digests(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text, a row of FILTER_BITS bits, packed, for each."""
    data, levels, starts, counts = windows_of(texts)
    short, wide = _hashes(data)
    keys = rank[levels] << _HASH_BITS | (wide >> np.uint64(64 - _HASH_BITS)).astype(np.int64)
    least, width = keys.copy(), 1
    while width < SPAN:
        least[:-width or None] = np.minimum(least[:-width or None], least[width:])
        width *= 2
    parts, filters = [], []                 # hashes, and the number of filters before them
    ends, total = [], 0
    for text, start, n in zip(texts, starts.tolist(), counts.tolist()):
        chosen = _selected(keys[start:start + n], least[start:start + max(n - SPAN + 1, 0)])
        parts.append(mix64(chosen.astype(np.uint64) & np.uint64((1 << _HASH_BITS) - 1)))
        filters.append(total + np.arange(len(chosen)) // FEATURES_PER_FILTER)
        total += -(-len(chosen) // FEATURES_PER_FILTER)
        if text:
            if len(text) < SHORT_WINDOW:
                of = _hashes(np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8))[0][:1]
            else:
                of = _least_short(short[start:start + len(text) - SHORT_WINDOW + 1])
            parts.append(mix64(of))         # the smallest have their first bits in common
            filters.append(np.full(len(of), total))
            total += 1
        ends.append(total)
    hashes = np.concatenate([np.zeros(0, np.uint64), *parts])
    filter_of = np.concatenate([np.zeros(0, np.int64), *filters])
    bits = np.zeros((total, FILTER_BITS), np.uint8)
    for i in range(BITS_PER_FEATURE):
        bits[filter_of, (hashes >> np.uint64(11 * i) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits, axis=1)
    return [packed[b:e] for b, e in zip([0, *ends], ends)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How alike two chains of filters are, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    ones = [np.bitwise_count(x).sum(axis=1).astype(np.float64) for x in (a, b)]
    best = np.zeros(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(axis=1)
        most = np.minimum(ones[0][i], ones[1])
        chance = ones[0][i] * ones[1] / FILTER_BITS
        room = np.where(most > chance, most - chance, 1.0)
        best[i] = np.clip(np.where(most > chance, (common - chance) / room, common == most), 0, 1).max()
    return float(best.mean())


def text_of(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def fingerprints_of(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    return digests([t.encode("utf-8", "surrogatepass") for t in texts], rank)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _compared(batches: Iterator[pd.DataFrame], rank: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows come range by range, each in order and followed by the first of the next range (halo)."""
    def finish(rows: list[tuple], following: tuple) -> pd.DataFrame:
        texts = [r[1] for r in rows] + [following[1]]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        own, other = fingerprints_of(texts, rank), fingerprints_of(changed, rank)
        return pd.DataFrame({
            "doc_id": pd.array([r[0] for r in rows], "Int64"), "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [text_of(c) for c in own[:-1]], "edited_fingerprint": [text_of(c) for c in other],
            "near_edited": [likeness(a, b) for a, b in zip(own, other)],
            "near_next": [likeness(a, b) for a, b in zip(own, own[1:])]})

    held: list[tuple] = []
    for rows in runs(batches):
        ids = [None if pd.isna(i) else int(i) for i in rows["doc_id"]]
        for doc_id, text, halo in zip(ids, rows["text"], rows["halo"]):
            if halo:
                if held:                    # of equal first rows, one is enough
                    yield finish(held, (doc_id, text))
                held = []
            else:
                held.append((doc_id, text))
        if len(held) > 1:
            yield finish(held[:-1], held[-1])
            held = held[-1:]


def in_ranges(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``docs`` (doc_id, text) dealt out by ranges of ids, in descending order, each with a row that follows it.

    What comes to the driver is one row for each of at most MOST_RANGES ranges.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = int(min(max(1, chars // range_chars), MOST_RANGES))
    cuts = sorted(set(texts.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] or [])) if n > 1 else []
    numbered = texts.withColumn("_at", F.col("doc_id").cast("double"))
    if cuts:
        ranged = Bucketizer(splits=[-float("inf"), *sorted(set(map(float, cuts))), float("inf")], inputCol="_at", outputCol="_range",
                            handleInvalid="keep").transform(numbered)
        ranged = ranged.withColumn("range", F.col("_range").cast("int")).drop("_at", "_range")
    else:
        ranged = numbered.withColumn("range", F.lit(0)).drop("_at")
    hashed = ranged.withColumn("tie", F.xxhash64("text"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    tops = sorted(hashed.groupBy("range").agg(F.max(rank).alias("top")).collect(), key=lambda row: row["range"])
    before = [row["range"] for row in tops[1:]] + [row["range"] for row in tops[:1]]
    firsts = docs.sparkSession.createDataFrame(
        [(row["range"], row["top"]["doc_id"], row["top"]["tie"], to) for row, to in zip(tops, before)],
        "r int, i long, t long, before int")
    marked = hashed.join(F.broadcast(firsts), (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("i"))
                         & (F.col("tie") == F.col("t")), "left")
    own = F.struct("range", F.lit(False).alias("halo"))
    both = F.when(F.col("before").isNotNull(), F.array(own, F.struct(F.col("before").alias("range"), F.lit(True).alias("halo")))).otherwise(F.array(own))
    dealt = marked.select("doc_id", "text", "tie", F.explode(both).alias("to")).select("doc_id", "text", "tie", "to.range", "to.halo")
    return (dealt.repartition(max(n, 1), "range")
            .sortWithinPartitions(F.desc("range"), "halo", F.desc_nulls_first("doc_id"), F.desc("tie")).drop("tie"))


def fingerprint(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Fingerprints of each of ``docs`` (doc_id, text) and of its edited text, and their likenesses."""
    rank = ranks(docs)
    return in_ranges(docs, range_chars).mapInPandas(lambda batches: _compared(batches, rank), ROWS)
