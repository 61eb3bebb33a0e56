"""Best-fit packing of token sequences.

Documents are turned into token ids, cut where they are longer than a sequence, and packed by bounded-space
best fit: a task keeps a fixed number of open bins, found through a bitset keyed by their free space; where one
more would be needed, the fullest open bin is closed. Items reach a task largest first.

Defined cases: a null or empty text is one item, the end token alone. Rows that repeat a doc_id, or have none,
are packed each on their own. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from loglens.llm.common import on_executors, runs, tidied
from loglens.session import Staging

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 2048
# Items of about so many tokens are packed by one task: a thousand sequences, of which the last few stay part empty.
TOKENS_PER_TASK = 4_000_000
# Memory for words and their ids in one Python worker, about; beyond that it starts over.
CACHED_BYTES = 128 << 20
# What an entry takes beside its characters and ids.
ENTRY_BYTES = 200

# Letters that are composed and have one lower-case letter wherever they stand, and signs. Text of these is cut as the
# tokenizer cuts it; words with others are left to it.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0391-\u03a1\u03a4-\u03a9\u03ac-\u03ce\u0400-\u0481\u048a-\u052f"
_SIGNS = ("\u00a1-\u00a9\u00ab\u00ac\u00ae-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7"
          "\u2010-\u2027\u2030-\u205e")
_PLAIN = re.compile(rf"[ -~\n{_LETTERS}{_SIGNS}]*")
_PIECE = re.compile(rf"[a-z{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{{-~{_SIGNS}]+")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None and "<|" not in text


class WordIds(dict):
    """Little-endian token ids of pieces of plain text in lower case, and of other words as they stand.

    No token spans a space or two pieces, so a text's ids are those of its parts. Parts not met before are encoded
    together: a piece ends with a token that says so, other words have a separator between them that is one token and in
    none of them.
    """

    SEPARATOR, END_OF_PIECE = "|", "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.of_pieces = Tokenizer(self.tokenizer.model)    # pieces are lower-cased and cut already
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.separator, = self._ids(self.tokenizer, self.SEPARATOR)
        vocabulary = self.of_pieces.get_vocab()
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for token, i in vocabulary.items() if token.endswith(self.END_OF_PIECE)]] = True
        self.held = 0

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        encoded, = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, dtype="<u4")

    def _keep(self, parts: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        data = ids.tobytes()
        self.update(zip(parts, map(data.__getitem__, map(slice, (4 * starts).tolist(), (4 * ends).tolist()))))
        self.held += len(parts) * ENTRY_BYTES + 4 * sum(map(len, parts)) + len(data)

    def learn(self, pieces: set[str], words: set[str]) -> None:
        if self.held > CACHED_BYTES:
            self.clear()
            self.held = 0
        new = list(pieces - self.keys())
        if new:
            ids = self._ids(self.of_pieces, " ".join(new))
            ends = np.flatnonzero(self.ends_piece[ids]) + 1
            self._keep(new, ids, np.concatenate([[0], ends[:-1]]), ends)
        new = list(words - self.keys())
        alone = [w for w in new if self.SEPARATOR in w]
        for word in alone:
            ids = self._ids(self.tokenizer, word)
            self._keep([word], ids, np.array([0]), np.array([len(ids)]))
        together = [w for w in new if self.SEPARATOR not in w]
        if together:
            ids = self._ids(self.tokenizer, f" {self.SEPARATOR} ".join(together))
            ends = np.flatnonzero(ids == self.separator)
            self._keep(together, ids, np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(ids)]]))

    def texts(self, texts: list[str]) -> list[bytes]:
        cut, pieces, others = [], set(), set()
        for text in texts:
            if _is_plain(text):
                parts = _PIECE.findall(text.lower())
                pieces.update(parts)
            else:
                parts = []
                for word in text.replace("\n", " ").split(" "):
                    if _is_plain(word):
                        of_word = _PIECE.findall(word.lower())
                        pieces.update(of_word)
                        parts += of_word
                    else:
                        others.add(word)
                        parts.append(word)
            cut.append(parts)
        self.learn(pieces, others)
        return [b"".join(map(self.__getitem__, parts)) for parts in cut]


def pieces_of(batches: Iterator[pd.DataFrame], path: str, capacity: int, end_id: int) -> Iterator[pd.DataFrame]:
    words, end, width = WordIds(path), np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
    for rows in runs(batches):
        out = []
        for doc_id, ids in zip(rows["doc_id"], words.texts(rows["text"].tolist())):
            ids += end
            for piece, at in enumerate(range(0, len(ids), width)):
                part = ids[at:at + width]
                out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
        made = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        yield made.astype({"doc_id": "Int64"})


class OpenBins:
    """Open bins by free space. A bit is set for each free space that some open bin has."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return taken

    def place(self, size: int) -> tuple[int, int]:
        """The bin that takes an item of ``size``, and the place in it."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen, self.made = self.capacity, self.made, self.made + 1
        left = free - size
        if left:
            if self.open >= self.limit:     # the fullest goes, be it this one
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest >= left:
                    return chosen, self.capacity - free
                self._take(fullest)
            self.by_free[left].append(chosen)
            self.bits |= 1 << left
            self.open += 1
        return chosen, self.capacity - free


def _packed(batches: Iterator[pd.DataFrame], capacity: int, open_bins: int) -> Iterator[pd.DataFrame]:
    bucket, bins = None, None
    for batch in batches:
        sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
        for i, (b, length) in enumerate(zip(batch["bucket"].tolist(), batch["length"].tolist())):
            if b != bucket:
                bucket, bins = b, OpenBins(capacity, open_bins)
            sequence[i], offset[i] = bins.place(length)
            sequence[i] += bucket << 32
        yield batch.assign(sequence_id=sequence, offset=offset).drop(columns="bucket")


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of ``docs`` (doc_id, text)."""
    texts = on_executors(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInPandas(lambda batches: tidied(pieces_of(batches, path, capacity, end_id)), PIECES)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
                tokens_per_task: int = TOKENS_PER_TASK) -> DataFrame:
    """Sequence and place of each piece. ``pieces`` must give the same rows in the same order each time it is read."""
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    part = F.col("length") < capacity
    tokens = pieces.where(part).agg(F.sum("length")).first()[0] or 0
    tasks = int(tokens // tokens_per_task) + 1
    whole = numbered.where(~part).select(*pieces.columns, (-1 - F.col("_row")).alias("sequence_id"),
                                         F.lit(0).cast("long").alias("offset"))
    dealt = (numbered.where(part).withColumn("bucket", F.pmod(F.xxhash64("_row"), F.lit(tasks)))
             .repartition(tasks, "bucket").sortWithinPartitions("bucket", F.desc("length"), "_row").drop("_row"))
    packed = dealt.mapInPandas(lambda batches: tidied(_packed(batches, capacity, open_bins)), PACKED)
    return whole.unionByName(packed)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   open_bins: int = OPEN_BINS, tokens_per_task: int = TOKENS_PER_TASK) -> DataFrame:
    """All of ``docs`` (doc_id, text) in sequences of at most ``capacity`` tokens, one row per piece."""
    staging = Staging(docs.sparkSession)
    pieces = staging.table(token_pieces(docs, path or tokenizer_path(), capacity, end_id), "pieces")
    return pack_pieces(pieces, capacity, open_bins, tokens_per_task)
