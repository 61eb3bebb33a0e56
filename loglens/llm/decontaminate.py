"""Benchmark decontamination by a prefix-filtered join.

A window of an item is a sequence of words that a document must hold as it is, so all of the window's shingles
(pairs of neighbouring words) must occur: of shingles in order of rarity, a prefix of one is enough. Each window
is found through its rarest shingle only, where rarity is the number of times a shingle occurs in all documents.
A match of that shingle fixes where the window would begin (positional bound), which must leave room for all of it
in the document (length bound); then the words are compared one by one. Only DataFrame functions run.

Defined cases: a null text has no words, as has one without letters and digits; such items have no windows. An item
shorter than a window is one window; an item of one word is its own shingle. Rows that repeat a doc_id are judged
each by its own text; items that repeat an item_id count once, items without item_id are searched for and hit, but
not counted or listed. Empty tables give no rows, or documents without hits. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglens.llm.common import lower_ascii
from loglens.session import Staging, is_small

WINDOW = 10
# Windows that may be broadcast: each holds at most WINDOW words and is well under a kilobyte.
BROADCAST_WINDOWS = 50_000

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), _SEPARATORS), ""), F.array().cast("array<string>"))


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows with the ids of the items that hold them: window (words), items (sorted ids)."""
    cut = items.select(F.col("item_id"), words("text").alias("w")).where(F.size("w") > 0)
    start = F.explode(F.expr(f"sequence(0, greatest(size(w) - {size}, 0))"))
    return (cut.select("item_id", "w", start.alias("start"))
            .select("item_id", F.expr(f"slice(w, start + 1, {size})").alias("window"))
            .groupBy("window").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))


def _shingles_at(size_column: str = "w") -> Column:
    """Hash of the shingle that begins at ``pos``; the last word begins none, if it isn't the only one."""
    return F.expr(f"xxhash64({size_column}[pos], {size_column}[pos + 1])")


def _occurrences(docs: DataFrame, single: bool) -> DataFrame:
    """Every shingle of every document with its place. ``single``: also single words."""
    at = docs.select("*", F.explode(F.expr("sequence(0, size(w) - 1)")).alias("pos"))
    pairs = at.where("pos < size(w) - 1").withColumn("shingle", _shingles_at())
    return pairs.unionByName(at.withColumn("shingle", F.expr("xxhash64(w[pos])"))) if single else pairs


def window_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Each occurrence of a window: the columns of ``docs`` but w (words), and start, length, items."""
    staging = Staging(docs.sparkSession)
    windows = staging.table(windows_of(items, size).withColumn("window_id", F.monotonically_increasing_id()), "windows")
    single = windows.where(F.size("window") == 1).limit(1).count() > 0
    shingles = windows.select("*", F.explode(F.expr("sequence(0, greatest(size(window) - 2, 0))")).alias("pos")).select(
        "window_id", "pos", F.when(F.size("window") == 1, F.expr("xxhash64(window[0])"))
        .otherwise(_shingles_at("window")).alias("shingle"))
    known = shingles.select("shingle").distinct()
    small = is_small(known, BROADCAST_WINDOWS) and is_small(windows, BROADCAST_WINDOWS)
    hint = F.broadcast if small else lambda side: side
    counts = _occurrences(docs.select("w").where("size(w) > 0"), single).select("shingle").join(
        hint(known), "shingle", "left_semi").groupBy("shingle").agg(F.count("*").alias("seen"))
    rarest = shingles.join(counts, "shingle", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle", "pos")).alias("least"))
    probes = staging.table(windows.join(rarest, "window_id").where("least.seen > 0").select(
        F.col("least.shingle").alias("shingle"), F.col("least.pos").alias("before"), "window", "items"), "probes")
    kept = [c for c in docs.columns if c != "w"]
    places = _occurrences(docs.where("size(w) > 0"), single)
    if not small:                           # what a window can need of a document goes along, not the document
        places = places.select(*kept, "shingle", "pos", F.expr(
            f"slice(w, greatest(pos - {size - 2}, 0) + 1, {2 * size})").alias("w"),
            F.expr(f"least(pos, {size - 2})").alias("at"))
    else:
        places = places.withColumn("at", F.col("pos"))
    found = places.join(hint(probes), "shingle").where(
        "at >= before and at - before + size(window) <= size(w) and slice(w, at - before + 1, size(window)) = window")
    return found.select(*kept, (F.col("pos") - F.col("before")).alias("start"), F.size("window").alias("length"), "items")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each of ``docs`` (doc_id, text)."""
    cut = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), words("text").alias("w"))
    hits = window_hits(cut, items, size)
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
    covered = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
                                F.greatest(acc["upto"], s["end"]).alias("upto")), lambda acc: acc["n"])
    per_doc = hits.groupBy("doc_id", "_text").agg(spans.alias("spans"), F.flatten(F.collect_set("items")).alias("items")).select(
        F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), covered.cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct("items")).alias("items"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (cut.select("doc_id", "_text", F.size("w").cast("long").alias("n_words"))
            .join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.size(listed).cast("long").alias("n_items"),
                    F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Those of ``docs`` (doc_id, text, others) without a hit. Only keys of what goes are joined to the texts."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    cut = docs.select(F.col("doc_id").alias("_id"), key.alias("_hash"), words("text").alias("w"))
    hit = Staging(docs.sparkSession).table(window_hits(cut, items, size).select("_id", "_hash").distinct(), "hit")
    hit = F.broadcast(hit) if is_small(hit) else hit
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_hash")), "left_anti")
