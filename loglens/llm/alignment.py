"""Alignment of two tokenizers over the same texts.

Both tokenizers cut a space and the text into tokens of bytes; where tokens of both end, a group ends, and all tokens of
one that share a group with a token of the other are linked. A pair of ids counts the documents that hold it linked.

Neither tokenizer has a token that runs on over a space behind a character that isn't white space (but for the sign by which
pieces write a space; texts that hold it can't be given back). So texts are cut there into spans, and each distinct span is
tokenized and aligned once, as long as a worker keeps it. Alignment is done on Arrow arrays: the
tokens of all spans are flattened with their parents' numbers, running sums of their bytes within each span give the ends,
a hash join on (span, end) finds those both have, running sums over these number the groups, and a join on groups gives
the links. Documents are lists of spans, and their links those of these. Pairs are counted by Table.group_by
for a sheet of texts in one place; Spark adds up the sheets' counts, and each sheet gets back those of its own pairs. Only
the highest count of each id of the first tokenizer is sent to all tasks, an array as long as its vocabulary.

Defined cases: a null or empty text, and one whose tokens don't give back its bytes, has no tokens. Rows that repeat
a doc_id, or have none, are documents of their own. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from loglens.llm.common import on_executors, runs
from loglens.session import Staging

# Characters of texts that are aligned together: some 20 MB of links.
RUN_CHARS = 2_000_000
# Characters of texts whose pairs are counted in one place, before Spark adds the counts up.
SHEET_CHARS = 8_000_000
# Characters of spans that one worker keeps aligned from run to run; beyond that it starts over.
KEPT_CHARS = 4_000_000
# Groups of more links have equal tokens counted before these are joined.
MANY_LINKS = 64
# Documents that are looked up in their sheet's counts together.
DOCS_AT_ONCE = 256

FIELDS = "sheet long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary, code long, docs long"


def first_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def second_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


_SPACE, _NO_CUT, _CUT = re.compile(r"\s"), re.compile(r"\s "), re.compile(r"(?<=\S) ")


def spans(text: str) -> list[str]:
    """A space and ``text``, cut before each space that follows a character other than white space.

    Each of these begins with a space, which is left out here.
    """
    if text[:1] != " " and not _NO_CUT.search(text):
        return text.split(" ")
    first, *others = _CUT.split(" " + text)
    return [first[1:], *others]


class ByteLevel:
    """A byte-level BPE: ids of spans, and the bytes of each id. The vocabulary is the file's; its ids are in order of merging."""

    def __init__(self, path: str):
        import json
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        special = {t["id"]: t["content"].encode() for t in data["added_tokens"] if t["special"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]       # bytes that stand for themselves
        other = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in data["model"]["vocab"].items() if i not in special}
        of_id = special | {i: token for token, i in ranks.items()}
        self.pieces = pa.array([of_id.get(i, b"") for i in range(max(of_id) + 1)], pa.binary())
        self.model = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.between, = self.model.encode_ordinary("\n")

    def ids(self, spans: list[str]) -> pa.ListArray:
        """Spans without more white space are encoded as one text of a line each: a line end before a space is one token."""
        plain = [i for i, s in enumerate(spans) if s and not _SPACE.search(s)]
        rest = sorted(set(range(len(spans))) - set(plain))
        flat = self.model.encode_to_numpy(" " + "\n ".join([spans[i] for i in plain])) if plain else np.zeros(0, np.int32)
        ends = np.flatnonzero(flat == self.between)
        starts = np.concatenate([[0], ends - np.arange(len(ends)), [len(flat) - len(ends)]])[:len(plain) + 1]
        lists = [pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(flat[flat != self.between].astype(np.int32))),
                 pa.array([self.model.encode_ordinary(" " + spans[i]) for i in rest], pa.list_(pa.int32()))]
        return pc.take(pa.concat_arrays(lists), pa.array(np.argsort(plain + rest)))


class Pieces:
    """A piece model that puts a space before what it is given: ids of spans, and the bytes of each id."""

    SPACE = "\N{LOWER ONE EIGHTH BLOCK}"

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = pa.array([bytes([int(n[1:-1], 16)]) if self.model.is_byte(i) else n.replace(self.SPACE, " ").encode()
                                for i, n in enumerate(names)], pa.binary())
        self.space = [self.model.piece_to_id(self.SPACE)]

    def ids(self, spans: list[str]) -> pa.ListArray:
        found = self.model.encode(spans, num_threads=1)
        return pa.array([f or self.space for f in found], pa.list_(pa.int32()))


class Tokenizers:
    """Both tokenizers."""

    def __init__(self, paths: tuple[str, str]):
        self.first, self.second = ByteLevel(paths[0]), Pieces(paths[1])

    def ids(self, spans: list[str]) -> list[pa.ListArray]:
        return [t.ids(spans) for t in (self.first, self.second)]


def _starts(lists: pa.ListArray) -> np.ndarray:
    return np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))


def _whole(lists: pa.ListArray, pieces: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Which of ``texts`` the bytes of their tokens give back."""
    tokens = pc.take(pieces, lists.flatten())
    ends = np.append(0, np.cumsum(pc.binary_length(tokens).to_numpy()))[_starts(lists)]
    joined, want = (tokens.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[:ends[-1]], b"".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if joined == want and (np.diff(ends) == sizes).all():
        return np.ones(len(texts), bool)
    return np.array([joined[a:b] == t for a, b, t in zip(ends[:-1], ends[1:], texts)], bool)


def _ends(lists: pa.ListArray, pieces: pa.Array) -> pa.Table:
    """Each token with its span, its id, and where it ends: its span's number and the bytes of the span up to there."""
    flat, span = lists.flatten(), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(pieces, flat)), pa.int64()))
    before = np.append(0, running.to_numpy())[_starts(lists)[:-1]]
    span = pc.cast(span, pa.int64())
    end = pc.add(pc.shift_left(span, 32), pc.subtract(running, pc.take(pa.array(before), span)))
    return pa.table({"span": span, "end": end, "id": flat, "at": np.arange(len(flat))})


def _groups(tokens: pa.Table, at: pa.ChunkedArray) -> np.ndarray:
    """The group of each token: how many of the common ends come before it."""
    closes = np.zeros(len(tokens), np.int64)
    closes[at.to_numpy()] = 1
    return pc.cumulative_sum(pa.array(closes)).to_numpy() - closes


class Aligned:
    """Groups and links of distinct spans. ``good``: spans that both tokenizers give back; others have no tokens here."""

    def __init__(self, texts: list[str], tokenizers: Tokenizers):
        first, second = tokenizers.first, tokenizers.second
        (a, b), data = tokenizers.ids(texts), [b" " + t.encode() for t in texts]
        self.good = _whole(a, first.pieces, data) & _whole(b, second.pieces, data)
        if not self.good.all():
            empty = pa.scalar([], a.type)
            a, b = (pc.if_else(pa.array(self.good), x, empty) for x in (a, b))
        n, tokens_a, tokens_b = len(texts), _ends(a, first.pieces), _ends(b, second.pieces)
        common = tokens_a.select(["end", "at"]).join(tokens_b.select(["end", "at"]), "end", join_type="inner", right_suffix="_b",
                                                     use_threads=False)
        group_a, group_b = _groups(tokens_a, common["at"]), _groups(tokens_b, common["at_b"])
        count = len(common)
        in_a, in_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        self.span_of = tokens_a["span"].to_numpy()[np.cumsum(in_a) - 1] if count else np.zeros(0, np.int64)
        self.n_a, self.n_b = np.diff(_starts(a)), np.diff(_starts(b))
        self.n_groups = np.bincount(self.span_of, minlength=n)
        self.n_links = np.zeros(n, np.int64)
        np.add.at(self.n_links, self.span_of, in_a * in_b)
        self.links = self._links(tokens_a["id"], group_a, tokens_b["id"], group_b, in_a * in_b > MANY_LINKS, len(second.pieces))
        self.texts = self._texts(a, b, in_a, in_b)

    def _links(self, a, group_a, b, group_b, many: np.ndarray, width: int) -> pa.Table:
        """span, code (both ids) and times of all links. In groups of ``many`` links equal tokens are counted before they are joined."""
        def joined(wanted: np.ndarray, counted: bool) -> pa.Table:
            sides = []
            for name, ids, group in (("a", a, group_a), ("b", b, group_b)):
                here = wanted[group]
                side = pa.table({"group": group[here], name: ids.filter(pa.array(here))})
                sides.append(side.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"{name}_times"])
                             if counted else side.append_column(f"{name}_times", pa.array(np.ones(len(side), np.int64))))
            return sides[0].join(sides[1], "group", join_type="inner", use_threads=False)

        both = pa.concat_tables([joined(~many, False), joined(many, True)] if many.any() else [joined(~many, False)])
        code = pc.add(pc.multiply(pc.cast(both["a"], pa.int64()), width), pc.cast(both["b"], pa.int64()))
        linked = pa.table({"span": pc.take(pa.array(self.span_of), both["group"]), "code": code, "times": pc.multiply(both["a_times"], both["b_times"])})
        return linked.group_by(["span", "code"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["span", "code", "times"])

    def _texts(self, a: pa.ListArray, b: pa.ListArray, in_a: np.ndarray, in_b: np.ndarray) -> pa.Array:
        """Groups of each span as text."""
        listed = [pc.binary_join(pa.LargeListArray.from_arrays(np.append(0, np.cumsum(n)), pc.cast(x.flatten(), pa.string())), ",")
                  for x, n in ((a, in_a), (b, in_b))]
        groups = pc.binary_join_element_wise(*listed, "|")
        return pc.binary_join(pa.LargeListArray.from_arrays(np.append(0, np.cumsum(self.n_groups)), groups), ";")


class Known:
    """Aligned spans that are kept from run to run, by number. Their links lie one span after the other."""

    NUMBERS = ("good", "n_a", "n_b", "n_groups", "n_links", "sizes")

    def __init__(self, paths: tuple[str, str], kept_chars: int = KEPT_CHARS):
        self.tokenizers, self.kept_chars = Tokenizers(paths), kept_chars
        self._forget()

    def _forget(self) -> None:
        self.places, self.chars, self.texts = {}, 0, pa.array([], pa.large_string())
        for name in (*self.NUMBERS, "codes", "times"):
            setattr(self, name, np.zeros(0, bool if name == "good" else np.int64))

    def numbers(self, spans: list[str]) -> np.ndarray:
        """Numbers of distinct ``spans``, aligned now if they weren't before."""
        new = [s for s in spans if s not in self.places]
        if self.chars + sum(map(len, new)) > self.kept_chars:
            self._forget()
            new = spans
        if new:
            self.places.update(zip(new, count(len(self.places))))
            self.chars += sum(map(len, new))
            aligned = Aligned(new, self.tokenizers)
            links = aligned.links.sort_by("span")
            aligned.codes, aligned.times = links["code"].to_numpy(), links["times"].to_numpy()
            aligned.sizes = np.bincount(links["span"].to_numpy(), minlength=len(new))
            for name in (*self.NUMBERS, "codes", "times"):
                setattr(self, name, np.concatenate([getattr(self, name), getattr(aligned, name)]))
            self.texts = pa.concat_arrays([self.texts, pc.cast(aligned.texts, pa.large_string())])
        return np.fromiter(map(self.places.__getitem__, spans), np.int64, len(spans))


@cache
def _known(paths: tuple[str, str]) -> Known:
    """One a worker, however many tasks it runs."""
    return Known(paths)


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of slices that begin at ``first``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _run(rows: pd.DataFrame, sheet: int, known: Known) -> tuple[pd.DataFrame, pa.Table]:
    """Rows of documents with their pairs, and how many of these documents hold each pair."""
    numbers: dict[str, int] = defaultdict(count().__next__)
    lists = pa.array([list(map(numbers.__getitem__, spans(text))) if text else [] for text in rows["text"]], pa.list_(pa.int64()))
    places = known.numbers(list(numbers))
    parent, starts = pc.cast(pc.list_parent_indices(lists), pa.int64()).to_numpy(), _starts(lists)
    place, n = places[lists.flatten().to_numpy()], len(rows)
    bad = np.diff(starts) == 0
    bad[parent[~known.good[place]]] = True

    def summed(of: np.ndarray) -> np.ndarray:
        running = np.append(0, np.cumsum(of[place]))
        return np.where(bad, 0, running[starts[1:]] - running[starts[:-1]])

    joined = pc.binary_join(pa.LargeListArray.from_arrays(starts, pc.take(known.texts, pa.array(place))), pa.scalar(";", pa.large_string()))
    sha = ["" if b else hashlib.sha256(t.encode()).hexdigest() for b, t in zip(bad.tolist(), joined.to_pylist())]
    # Distinct spans of documents, then their links: a document's pairs are those of its spans
    width = max(len(known.good), 1)
    held, often = np.unique((parent * width + place)[~bad[parent]], return_counts=True)
    doc, span = held // width, held % width
    sizes = known.sizes[span]
    at = _ragged((np.cumsum(known.sizes) - known.sizes)[span], sizes)
    pairs = pa.table({"doc": np.repeat(doc, sizes), "code": known.codes[at], "times": known.times[at] * np.repeat(often, sizes)})
    pairs = pairs.group_by(["doc", "code"], use_threads=False).aggregate([("times", "sum")]).sort_by([("doc", "ascending"), ("code", "ascending")])
    doc, codes, times = (pairs[c].to_numpy() for c in ("doc", "code", "times_sum"))
    cut = np.searchsorted(doc, np.arange(n + 1))
    packed = lambda x, kind: [x[a:b].astype(kind).tobytes() for a, b in zip(cut[:-1], cut[1:])]
    small, large = packed(np.minimum(times, 255), "<u1"), packed(times, "<i8")
    out = pd.DataFrame({"sheet": sheet, "doc_id": rows["doc_id"].astype("Int64").array, "n_a": summed(known.n_a), "n_b": summed(known.n_b),
                        "n_groups": summed(known.n_groups), "n_links": summed(known.n_links), "groups_sha256": pd.Series(sha, dtype=object),
                        "codes": packed(codes, "<u4"), "times": [x if b"\xff" not in x else y for x, y in zip(small, large)],
                        "code": pd.array([None] * n, "Int64"), "docs": pd.array([None] * n, "Int64")})
    return out, pa.table({"code": codes}).group_by("code", use_threads=False).aggregate([([], "count_all")]).rename_columns(["code", "docs"])


def _added(counts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(counts).group_by("code", use_threads=False).aggregate([("docs", "sum")]).rename_columns(["code", "docs"])


def _sheets(batches: Iterator[pd.DataFrame], paths: tuple[str, str], sheet_chars: int) -> Iterator[pd.DataFrame]:
    """Documents in sheets, and after each sheet its pairs with their counts."""
    from pyspark import TaskContext
    known = _known(paths)
    sheet, chars, counts = TaskContext.get().partitionId() << 32, 0, []

    def counted() -> pd.DataFrame:
        added = _added(counts).sort_by("code")
        filled = {"sheet": sheet, "code": added["code"].to_numpy(), "docs": added["docs"].to_numpy()}
        return pd.DataFrame({c: filled.get(c, pd.Series([None] * len(added), dtype=object)) for c in _COLUMNS})

    for rows in runs(batches, chars=RUN_CHARS):
        docs, part = _run(rows, sheet, known)
        yield docs
        counts = [_added([*counts, part])]
        pa.default_memory_pool().release_unused()
        chars += int(rows["text"].str.len().sum())
        if chars >= sheet_chars:
            yield counted()
            sheet, chars, counts = sheet + 1, 0, []
    if counts:
        yield counted()


_COLUMNS = [f.split()[0] for f in FIELDS.split(", ")]


def _unpacked(times: bytes, n: int) -> np.ndarray:
    """Times of ``n`` pairs: a byte each, or eight where one would not do for all."""
    return np.frombuffer(times, "<u1" if len(times) == n else "<i8").astype(np.int64)


def _looked_up(batches: Iterator[pd.DataFrame], highest, width: int) -> Iterator[pd.DataFrame]:
    """Sums over the links of documents. Rows arrive sheet by sheet, its pairs first and in order."""
    sheet, codes, counts, parts = None, None, None, []
    for batch in batches:
        for number, rows in batch.groupby("sheet", sort=False):
            if number != sheet:
                sheet, codes, parts = number, None, []
            given = rows["code"].notna()
            if given.any():
                parts.append((rows.loc[given, "code"].to_numpy(np.int64), rows.loc[given, "docs"].to_numpy(np.int64)))
            rows = rows[~given]
            if len(rows) and codes is None:
                codes, counts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
                parts = []
            for start in range(0, len(rows), DOCS_AT_ONCE):
                docs = rows.iloc[start:start + DOCS_AT_ONCE]
                held = np.frombuffer(b"".join(docs["codes"]), "<u4").astype(np.int64)
                times = np.concatenate([_unpacked(t, len(c) // 4) for t, c in zip(docs["times"], docs["codes"])])
                count = counts[np.searchsorted(codes, held)]
                best = np.where(count == highest.value[held // width], times, 0)
                cut = np.append(0, np.cumsum(docs["codes"].str.len().to_numpy() // 4))
                summed = lambda x: np.diff(np.append(0, np.cumsum(x))[cut])
                yield docs[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].assign(
                    n_best=summed(best), count_sum=summed(times * count), groups_sha256=docs["groups_sha256"].astype(object))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, sheet_chars: int = SHEET_CHARS) -> DataFrame:
    """Tokens, groups and links of each of ``docs`` (doc_id, text), and what the counts of its links come to."""
    spark = docs.sparkSession
    work, answer = Staging(spark), Staging(spark)
    paths = paths or (first_path(), second_path())
    texts = on_executors(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = work.table(texts.mapInPandas(lambda batches: _sheets(batches, paths, sheet_chars), FIELDS), "sheets")
    size, width = len(ByteLevel(paths[0]).pieces), len(Pieces(paths[1]).pieces)
    parts = rows.where("code is not null").select("sheet", "code", "docs")
    totals = work.table(parts.groupBy("code").agg(F.sum("docs").alias("docs")), "totals")
    highest = np.zeros(size, np.int64)
    for r in totals.groupBy(F.expr(f"code div {width}").alias("id")).agg(F.max("docs").alias("docs")).collect():
        highest[r["id"]] = r["docs"]
    sent = spark.sparkContext.broadcast(highest)
    counts = parts.select("sheet", "code").join(totals, "code")
    both = rows.where("code is null").unionByName(counts, allowMissingColumns=True)
    both = both.repartition("sheet").sortWithinPartitions("sheet", F.asc_nulls_last("code"))
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    result = answer.table(both.mapInPandas(lambda batches: _looked_up(batches, sent, width), kind), "result")
    work.drop()
    return result
