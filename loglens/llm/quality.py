"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

The model's five-grams are counted over all trusted documents; lower orders count in how many different contexts a
gram occurs. Counts, discounts and interpolation are joins sharded by gram and by context. Documents are scored
against the finished tables in shards of bounded size: a shard holds all that the last two characters of a context
can need, so each text position is scored in exactly one of them, and a document's score is the sum over shards.

A share of the trusted documents is kept out of the counts. Their cross-entropies give, for each language, the
quantile beyond which a document is rejected. Entropies are shrunk towards the language's mean, so that a short
text is not rejected for want of evidence.

Defined cases: digits count as one character. A null or empty text has no perplexity and is rejected. Rows that
repeat a doc_id are judged each by its own text. A null or unknown language is judged by the quantile of all
trusted text. Without trusted documents nothing can be told: perplexity and threshold are null and all texts that
aren't empty are kept. Columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loglens.llm.common import on_executors, runs, small_batches, tidied
from loglens.session import Staging, join_checked

ORDER = 5
QUANTILE = 0.99
HELD_OUT_ONE_IN = 5
SHRINK_CHARS = 200
# Rows of a model's shard that a task holds; more rows make more shards, each with a scan of its own.
SHARD_ROWS = 2_000_000
# Characters scored or counted at a time: each takes about a hundred bytes of a worker's memory meanwhile.
RUN_CHARS = 250_000

START = "\x02"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after ``order - 1`` start marks, and where the texts begin."""
    marks = START * (order - 1)
    codes = np.frombuffer((marks + marks.join(texts)).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    codes[(codes >= 48) & (codes <= 57)] = 48
    starts = np.cumsum([order - 1, *(len(t) + order - 1 for t in texts[:-1])])
    return codes, starts


def gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """For each place, a key of the ``n`` characters that end there; the first n - 1 places are of no use."""
    keys = np.zeros(len(codes), np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    for i in range(n - 1, -1, -1):
        keys[i:] = keys[i:] * _FACTOR + wide[:max(len(wide) - i, 0)]
    return keys


def _scored_places(starts: np.ndarray, texts: list[str], size: int) -> np.ndarray:
    places = np.zeros(size, bool)
    for start, text in zip(starts.tolist(), texts):
        places[start:start + len(text)] = True
    return places


def _counted(batches: Iterator[pd.DataFrame], order: int) -> Iterator[pd.DataFrame]:
    for rows in runs(batches, chars=RUN_CHARS):
        texts = rows["text"].tolist()
        codes, starts = _codes(texts, order)
        at = np.flatnonzero(_scored_places(starts, texts, len(codes)))
        _, first, n = np.unique(gram_keys(codes, order)[at], return_index=True, return_counts=True)
        text = codes.tobytes().decode("utf-32-le", "surrogatepass")
        yield pd.DataFrame({"gram": [text[i - order + 1:i + 1] for i in at[first].tolist()], "n": n})


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts of counts of one, two, and three or more."""
    n = counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("many")).collect()
    n = {row["n"]: row["many"] for row in n}
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), most) for d, most in zip(raw, (0.9, 1.8, 2.7))]


def _model(grams: DataFrame, order: int, staging: Staging) -> DataFrame:
    """Rows (n, gram, is_context, log2): of a gram its interpolated probability, of a context its weight of lower orders."""
    counts = {order: grams}
    for n in range(order - 1, 0, -1):       # in how many contexts a gram is seen; after a start mark it is as counted
        counts[n] = staging.table(counts[n + 1].select(F.substring("gram", 2, n).alias("gram"))
                                  .groupBy("gram").agg(F.count("*").alias("n")), f"counts-{n}")
    def rows(table: DataFrame, n: int, gram: str | Column, is_context: bool, value: Column) -> DataFrame:
        return table.select(F.lit(n).alias("n"), (F.col(gram) if isinstance(gram, str) else gram).alias("gram"),
                            F.lit(is_context).alias("is_context"), F.log2(value).alias("log2"))

    lower, tables = None, []
    for n in range(1, order + 1):
        d = _discounts(counts[n])
        of = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        table = counts[n].withColumn("context", F.substring("gram", 1, n - 1)).withColumn("discount", of)
        contexts = table.groupBy("context").agg(F.sum("n").alias("all"), F.sum("discount").alias("given"))
        table = table.join(contexts, "context")
        own, weight = (F.col("n") - F.col("discount")) / F.col("all"), F.col("given") / F.col("all")
        if n == 1:                          # beyond that, all characters alike, one unseen among them
            kinds = counts[1].count() + 1
            table = table.withColumn("p", own + weight / kinds)
            tables.append(rows(contexts, 0, F.lit(""), True, weight / kinds))
        else:
            shorter = lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below"))
            table = (table.withColumn("shorter", F.substring("gram", 2, n - 1)).join(shorter, "shorter")
                     .withColumn("p", own + weight * F.col("below")))
            tables.append(rows(contexts, n - 1, "context", True, weight))
        lower = staging.table(table.select("gram", "p"), f"order-{n}")
        tables.append(rows(lower, n, "gram", False, F.col("p")))
    model = tables[0]
    for more in tables[1:]:
        model = model.unionByName(more)
    return staging.table(model, "model")


def train(trusted: DataFrame, order: int = ORDER, staging: Staging | None = None) -> DataFrame:
    """The model of ``trusted`` (text): a row for every gram and context of up to ``order`` characters."""
    staging = staging or Staging(trusted.sparkSession)
    texts = on_executors(trusted).select(F.col("text").cast("string"))
    grams = (texts.mapInPandas(lambda batches: tidied(_counted(batches, order)), "gram string, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")))
    return _model(staging.table(grams, f"counts-{order}"), order, staging)


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each place, by the two characters before it."""
    pair = np.zeros(len(codes), np.uint64)
    pair[2:] = codes[:-2].astype(np.uint64) * np.uint64(1 << 21) + codes[1:-1]
    return (pair * _FACTOR >> np.uint64(32)) % np.uint64(shards)


def _keyed(batches: Iterator[pd.DataFrame], order: int, shards: int) -> Iterator[pd.DataFrame]:
    """Rows of a model by numeric key. ``shard`` is -1 where contexts are too short to tell; ``slot`` is n for a gram
    and n beyond ``order`` for a context."""
    for batch in batches:
        keys, shard = np.zeros(len(batch), np.uint64), np.full(len(batch), -1, np.int64)
        for i, (n, gram, is_context) in enumerate(zip(batch["n"], batch["gram"], batch["is_context"])):
            codes = np.array([ord(c) for c in gram], "<u4")
            if n:
                keys[i] = gram_keys(codes, n)[-1]
            if n + is_context > 2:
                shard[i] = shard_of(np.append(codes, 0) if is_context else codes, shards)[-1]
        slot = batch["n"] + np.where(batch["is_context"], order + 1, 0)
        yield pd.DataFrame({"slot": slot, "key": keys.view(np.int64), "shard": shard, "log2": batch["log2"].astype("float32")})


def packed(keyed: DataFrame, order: int) -> tuple[list[int], bytes, bytes]:
    """Rows by slot: how many of each, and their keys and values end to end."""
    table = keyed.select("slot", "key", "log2").toArrow()
    slots = table["slot"].to_numpy()
    by_slot = np.argsort(slots, kind="stable")
    return (np.bincount(slots, minlength=2 * order + 2).tolist(), table["key"].to_numpy()[by_slot].tobytes(),
            table["log2"].to_numpy()[by_slot].astype("f4").tobytes())


class Tables:
    """One shard of a model, ready to be looked up."""

    def __init__(self, many: list[int], keys: bytes, values: bytes):
        self.order, ends = len(many) // 2 - 1, np.cumsum(many)[:-1]
        index = [pd.Index(part) for part in np.split(np.frombuffer(keys, np.uint64), ends)]
        values = np.split(np.frombuffer(values, np.float32), ends)
        self.grams, self.contexts = (list(zip(index[at:at + self.order + 1], values[at:at + self.order + 1])) for at in (0, self.order + 1))

    def bits(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Minus log2 of the probability of the character at each of the places ``at``."""
        out, open_ = np.zeros(len(at), np.float64), np.arange(len(at))
        for n in range(self.order, 0, -1):
            index, values = self.grams[n]
            found = index.get_indexer(gram_keys(codes, n)[at[open_]])
            hit = found >= 0
            out[open_[hit]] -= values[found[hit]]
            open_ = open_[~hit]
            if n > 1 and len(open_):
                index, values = self.contexts[n - 1]
                found = index.get_indexer(gram_keys(codes, n - 1)[at[open_] - 1])
                seen = found >= 0
                out[open_[seen]] -= values[found[seen]]
        if len(open_):
            out[open_] -= self.contexts[0][1][0]
        return out


def _bits(batches: Iterator[pd.Series], shard_rows, order: int, shard: int, shards: int) -> Iterator[pd.Series]:
    tables = Tables(*shard_rows.value)
    for batch in batches:
        out = []
        for rows in runs(iter([pd.DataFrame({"text": batch})]), chars=RUN_CHARS):
            texts = rows["text"].tolist()
            codes, starts = _codes(texts, order)
            places = _scored_places(starts, texts, len(codes))
            if shards > 1:
                places &= shard_of(codes, shards) == shard
            at, sums = np.flatnonzero(places), np.zeros(len(codes) + 1)
            sums[at + 1] = tables.bits(codes, at)
            sums = np.cumsum(sums)
            ends = starts + np.array([len(t) for t in texts], np.int64)
            out.append(sums[ends] - sums[starts])
        yield pd.Series(np.concatenate(out) if out else np.zeros(0))


class Scorer:
    """A model in shards of at most about ``shard_rows`` rows, each sent out once."""

    def __init__(self, model: DataFrame, staging: Staging, order: int = ORDER, shard_rows: int = SHARD_ROWS):
        self.staging, self.order = staging, order
        shards = self.shards = -(-model.count() // shard_rows) or 1
        keyed = on_executors(model).mapInPandas(lambda batches: tidied(_keyed(batches, order, shards)),
                                                "slot int, key long, shard long, log2 float")
        keyed = staging.table(keyed, "keyed") if shards > 1 else keyed
        send = model.sparkSession.sparkContext.broadcast
        self.rows = [send(packed(keyed.where(F.col("shard").isin(-1, shard)), order)) for shard in range(shards)]

    def with_bits(self, docs: DataFrame, to: str = "_bits", text: str = "text") -> DataFrame:
        """``docs`` with the cross-entropy, in bits, of the whole text."""
        scored, order, shards = docs.withColumn(to, F.lit(0.0)), self.order, self.shards
        for shard, rows in enumerate(self.rows):
            def bits(batches: Iterator[pd.Series], rows=rows, shard=shard) -> Iterator[pd.Series]:
                return tidied(_bits(batches, rows, order, shard, shards))

            of = F.pandas_udf(bits, "double", F.PandasUDFType.SCALAR_ITER)
            scored = scored.withColumn(to, F.col(to) + of(F.coalesce(F.col(text).cast("string"), F.lit(""))))
            if shard + 1 < shards:          # one shard in memory at a time
                scored = self.staging.table(scored, f"scored-{to}-{shard}")
        return scored


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER,
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``docs`` with _bits, _chars, _threshold (bits per character, shrunk) and _keep added.

    Trusted are the documents whose ``labels`` (doc_id, quality) say 1.
    """
    staging = Staging(docs.sparkSession)
    small_batches(docs.sparkSession)
    sure = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    trusted = join_checked(docs.select("doc_id", "text", "lang").where("text <> ''"), sure, "doc_id", "left_semi")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT_ONE_IN)) == 0
    model = train(trusted.where(~held), order, staging)
    chars = F.char_length(F.coalesce(F.col("text"), F.lit("")))
    if not model.limit(1).count():
        return docs.withColumns({"_bits": F.lit(None).cast("double"), "_chars": chars, "_threshold": F.lit(None).cast("double"),
                                 "_keep": chars > 0})
    scorer = Scorer(model, staging, order, shard_rows)
    held_out = staging.table(
        scorer.with_bits(trusted.where(held), "_held").select("lang", "_held", chars.alias("chars")), "held-out")
    mean = F.sum("_held") / F.sum("chars")
    means = held_out.groupBy(F.col("lang").alias("_lang")).agg(mean.alias("mean"))
    overall = held_out.agg(mean.alias("mean")).first()["mean"]
    overall = overall if overall is not None else 0.0
    entropies = held_out.join(means, F.col("lang") == F.col("_lang"), "left").select(
        "lang", _shrunk("_held", "chars", F.coalesce("mean", F.lit(overall))).alias("h"), "mean")
    cut = F.percentile_approx("h", F.lit(quantile), F.lit(10_000))
    limits = staging.table(entropies.where("lang is not null").groupBy(F.col("lang").alias("_lang")).agg(
        cut.alias("_limit"), F.first("mean").alias("_mean")), "limits")
    anywhere = entropies.agg(cut.alias("limit")).first()["limit"]
    anywhere = F.lit(anywhere).cast("double")
    scored = scorer.with_bits(docs).withColumn("_chars", chars)
    scored = scored.withColumn("_lang", F.col("lang"))
    judged_ = join_checked(scored, limits, "_lang", "left")
    entropy = _shrunk("_bits", "_chars", F.coalesce("_mean", F.lit(overall)))
    threshold = F.coalesce("_limit", anywhere)
    return judged_.withColumn("_keep", (F.col("_chars") > 0) & (threshold.isNull() | (entropy <= threshold))).withColumn(
        "_threshold", threshold).drop("_lang", "_limit", "_mean")


def _shrunk(bits: str, chars: str, mean: Column) -> Column:
    return (F.col(bits) + SHRINK_CHARS * mean) / (F.col(chars) + SHRINK_CHARS)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, lang, perplexity (per character), threshold and keep for each of ``docs`` (doc_id, text, lang)."""
    rows = judged(docs.select("doc_id", "text", "lang"), labels, quantile, order, shard_rows)
    return rows.select("doc_id", "lang", F.when(F.col("_chars") > 0, F.pow(F.lit(2.0), F.col("_bits") / F.col("_chars"))).alias("perplexity"),
                       F.col("_threshold").alias("threshold"), F.col("_keep").alias("keep"))


def filter_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Those of ``docs`` that are kept, with their own columns."""
    return judged(docs, labels, quantile).where("_keep").select(*docs.columns)
