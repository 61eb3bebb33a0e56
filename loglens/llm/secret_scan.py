"""Secret scans: named patterns, and a battery of randomness tests for strings that no pattern names.

Candidates are runs of base64 characters, or what named patterns leave of them. Of each, the encoding is inferred
(hexadecimal, base32, base62 or base64) and three tests ask whether its symbols look drawn at random: chi-squared
uniformity over parts of the alphabet, runs above and below its middle, and serial correlation of neighbours. Their
p-values are combined by Fisher's method: random strings have any, words run together have small ones.

What is controlled is the rate of words among the strings reported. The corpus itself says how often words reach a
p-value: its plain words, run together with a capital each, are cut into strings of each class of length and tested.
Candidates are classed by length and by the kinds of characters they have; within a class, Benjamini-Hochberg control
at FALSE_DISCOVERY finds the least p-value that is reported as ``random``. So it is the class that decides on short
strings, and where a corpus has too few words to tell, no string is reported but by name. Numbers are no candidates.

Defined cases: a null or empty text has no spans. Rows that repeat a doc_id, or have none, are scanned each on their
own. An empty table gives no rows. Columns other than doc_id and text are not looked at by ``scan`` and are handed
through by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from loglens.llm.common import on_executors, runs, tidied

FALSE_DISCOVERY = 0.01
# p-values are counted in bins of a tenth of a decimal order.
BINS_PER_ORDER = 10
LEAST_ORDER = 30
# Classes of length double from here on; a string with fewer symbols holds fewer bits than a password should.
CLASS_LENGTHS = (8, 16, 32, 64, 128)

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % CLASS_LENGTHS[0])
_PLAIN_WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{1,15}(?![A-Za-z0-9+/_=-])")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")

SPANS = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters that are frequent in most languages of Latin script.
_FREQUENT = "aeinorst"
_RARE = "".join(c for c in _LOWER if c not in _FREQUENT)
# Symbols in order of their values, and the parts of the alphabet that are counted; the first that has all symbols of a run is inferred.
ENCODINGS = [
    ("hex", _DIGITS + "abcdef", ["01234", "56789", "abc", "def"]), ("hex", _DIGITS + "ABCDEF", ["01234", "56789", "ABC", "DEF"]),
    ("base32", _UPPER + "234567", [_FREQUENT.upper(), _RARE.upper(), "234567"]),
    ("base62", _UPPER + _LOWER + _DIGITS, [_UPPER, _FREQUENT, _RARE, _DIGITS]),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/-_", [_UPPER, _FREQUENT, _RARE, _DIGITS, "+/-_"])]
_PARTS = 5
# Of each encoding and character: its value, its part, and whether the encoding lacks it; the URL form's signs are +/ again.
_VALUE, _PART = np.zeros((len(ENCODINGS), 128)), np.zeros((len(ENCODINGS), 128), np.int64)
_LACKS = np.zeros(128, np.uint8)
_SIZE = np.array([min(len(symbols), 64) for _, symbols, _ in ENCODINGS])
_SHARE = np.zeros((len(ENCODINGS), _PARTS))
for _e, (_, _symbols, _parts) in enumerate(ENCODINGS):
    for _i, _c in enumerate(_symbols):
        _VALUE[_e, ord(_c)] = _i if _i < 64 else _i - 2
    for _i, _part in enumerate(_parts):
        _PART[_e, [ord(c) for c in _part]] = _i
        _SHARE[_e, _i] = (2 if "+" in _part else len(_part)) / _SIZE[_e]
    for _c in range(128):
        if chr(_c) not in _symbols:
            _LACKS[_c] |= 1 << _e
_FREE = (_SHARE > 0).sum(axis=1) - 1
_KIND = np.zeros(128, np.uint8)             # lower, upper, digit, sign
for _i, _part in enumerate((_LOWER, _UPPER, _DIGITS, "+/-_")):
    _KIND[[ord(c) for c in _part]] = 1 << _i


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, x.tolist()), float, len(x))


class Battery:
    """The three tests of many strings, none of them empty, at once."""

    def __init__(self, strings: list[str]):
        symbols = np.frombuffer("".join(strings).encode("ascii"), np.uint8)
        self.length = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.length) - self.length
        self.of = np.repeat(np.arange(len(strings)), self.length)
        lacking = np.bitwise_or.reduceat(_LACKS[symbols], self.starts)
        self.encoding = np.argmin(lacking[:, None] >> np.arange(len(ENCODINGS)) & 1, axis=1)
        self.form = np.bitwise_or.reduceat(_KIND[symbols], self.starts)
        self.value, self.part = _VALUE[self.encoding[self.of], symbols], _PART[self.encoding[self.of], symbols]
        self.follows = np.ones(len(symbols), bool)
        self.follows[self.starts] = False

    def _sum(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts)

    def uniformity(self) -> np.ndarray:
        """p-values of the counts in the parts of the alphabet."""
        counts = np.bincount(self.of * _PARTS + self.part, minlength=_PARTS * len(self.length)).reshape(-1, _PARTS)
        share, free = _SHARE[self.encoding], _FREE[self.encoding]
        expected = self.length[:, None] * share
        x = np.where(share > 0, (counts - expected) ** 2 / np.where(share > 0, expected, 1), 0).sum(axis=1)
        tail = np.exp(-x / 2)
        three = _erfc(np.sqrt(x / 2)) + np.sqrt(2 * x / math.pi) * tail
        return np.choose(free - 2, [tail, three, tail * (1 + x / 2)])

    def runs(self) -> np.ndarray:
        """p-values of the numbers of runs above and below the middle of the alphabet."""
        above = 2 * self.value >= _SIZE[self.encoding[self.of]]
        n = self._sum(above.astype(np.int64))
        m = self.length - n
        mean = 1 + 2 * n * m / (n + m)
        spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / np.maximum(n + m - 1, 1), 0))
        changed = np.concatenate([[False], above[1:] != above[:-1]]) & self.follows
        away = np.abs(1 + self._sum(changed.astype(np.int64)) - mean)
        p = _erfc(away / np.where(spread > 0, spread, 1) / math.sqrt(2))
        return np.where((n == 0) | (m == 0), 2.0 ** (1 - np.minimum(self.length, 1000)), np.where(spread > 0, p, 1.0))

    def serial_correlation(self) -> np.ndarray:
        """p-values of the correlation of neighbours."""
        off = self.value - (self._sum(self.value) / self.length)[self.of]
        spread = self._sum(off * off)
        r = self._sum(np.concatenate([[0.0], off[1:] * off[:-1]]) * self.follows) / np.where(spread > 0, spread, 1)
        p = _erfc(np.abs(r + 1 / self.length) * np.sqrt(self.length) / math.sqrt(2))
        return np.where(spread > 0, p, 2.0 ** (1 - np.minimum(self.length, 1000)))

    def p(self) -> np.ndarray:
        """Fisher's combination of the three: small where a string does not look random."""
        x = -sum(np.log(np.maximum(p, 1e-300)) for p in (self.uniformity(), self.runs(), self.serial_correlation()))
        return np.exp(-x) * (1 + x + x * x / 2)     # twice x has six degrees of freedom

    def bins(self) -> np.ndarray:
        """Bins of the p-values: each is at most 10 ** (-bin / BINS_PER_ORDER)."""
        orders = -np.log10(np.maximum(self.p(), 1e-300))
        return np.minimum((np.maximum(orders, 0) * BINS_PER_ORDER).astype(np.int64), LEAST_ORDER * BINS_PER_ORDER)

    def classes(self) -> np.ndarray:
        """Place in CLASS_LENGTHS of each string's class."""
        return np.searchsorted(CLASS_LENGTHS, self.length, side="right") - 1


def randomness(run: str) -> float:
    return float(Battery([run.rstrip("=")]).p()[0])


def base_spans(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find; hex and access strings lie within candidates."""
    spans, low = [], text.lower()
    if any(name in low for name in _NAMES):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    for start, end, run in found:
        if end - start < 20:
            continue
        spans += [(start + m.start(), 1, start + m.end()) for m in _ACCESS.finditer(run) if m.end() - m.start() >= 20]
        spans += [(start + m.start(), 2, start + m.end()) for m in _HEX.finditer(run) if m.end() - m.start() >= 24]
    return sorted(spans)


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str]]]:
    """Base spans, and (start, end, string) of what they leave of runs, without padding."""
    found = [(m.start(), m.end(), m[0]) for m in _RUN.finditer(text)]
    base, parts, i, covered = base_spans(text, found), [], 0, 0
    for start, end, run in found:
        at, rest = max(start, covered), []          # an assignment may go on from the run before
        while i < len(base) and base[i][0] < end:
            s, _, e = base[i]
            rest.append((at, min(max(s, at), end)))
            at, covered, i = max(at, e), max(covered, e), i + 1
        rest.append((at, end))
        for a, b in rest:
            string = text[a:b].strip("=") if a < b else ""
            if len(string) >= CLASS_LENGTHS[0] and not string.isdigit():
                a = text.index(string, a)
                parts.append((a, a + len(string), string))
    return base, parts


def words_run_together(texts: list[str]) -> list[str]:
    """The plain words of ``texts`` run together, cut into strings of each class's length in turn."""
    joined = " ".join(word for text in texts for word in _PLAIN_WORD.findall(text)).title().replace(" ", "")
    out, at, turn = [], 0, 0
    while at + CLASS_LENGTHS[turn] <= len(joined):
        out.append(joined[at:at + CLASS_LENGTHS[turn]])
        at, turn = at + CLASS_LENGTHS[turn], (turn + 1) % len(CLASS_LENGTHS)
    return out


_WORDS_FORM = -1


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in runs(batches):
        texts = rows["text"].tolist()
        for strings, are_words in (([s for text in texts for _, _, s in candidates(text)[1]], False), (words_run_together(texts), True)):
            if strings:
                battery = Battery(strings)
                seen = pd.DataFrame({"length_class": battery.classes(), "form": battery.form.astype(np.int64), "bin": battery.bins()})
                if are_words:
                    seen["form"] = _WORDS_FORM
                yield seen.value_counts().rename("n").reset_index()


def cuts_of(seen: dict[tuple[int, int], dict[int, int]], rate: float) -> dict[tuple[int, int], int]:
    """By class of length and form, the last bin that is reported. ``seen``: by the same, how many strings fall in each bin."""
    cuts = {}
    for (length, form), bins in seen.items():
        if form == _WORDS_FORM:
            continue
        words = seen.get((length, _WORDS_FORM), {})
        total, all_words, reported, reached = sum(bins.values()), sum(words.values()), 0, 0
        for b in range(LEAST_ORDER * BINS_PER_ORDER + 1):
            reported, reached = reported + bins.get(b, 0), reached + words.get(b, 0)
            if reported and total * (reached + 1) / (all_words + 1) <= rate * reported:
                cuts[length, form] = b
    return cuts


def reported_bins(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[tuple[int, int], int]:
    """By class of length and form, the last bin of p-values that is reported; counted over all of ``docs``.

    What comes to the driver is a count for each class, form and bin, whatever the input.
    """
    texts = on_executors(docs).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = (texts.mapInPandas(lambda batches: tidied(_counted(batches)), "length_class int, form int, bin int, n long")
              .groupBy("length_class", "form", "bin").agg(F.sum("n").alias("n")).collect())
    seen: dict[tuple[int, int], dict[int, int]] = {}
    for row in counts:
        seen.setdefault((row["length_class"], row["form"]), {})[row["bin"]] = row["n"]
    return cuts_of(seen, rate)


def spans_of(texts: list[str], cuts: dict[tuple[int, int], int]) -> Iterator[tuple[list, list]]:
    """Base spans and all spans of each text."""
    found = [candidates(text) for text in texts]
    strings = list({s for _, parts in found for _, _, s in parts}) if cuts else []
    random = set()
    if strings:
        battery = Battery(strings)
        limit = [cuts.get(key, -1) for key in zip(battery.classes().tolist(), battery.form.tolist())]
        random = {s for s, b, most in zip(strings, battery.bins().tolist(), limit) if b <= most}
    for base, parts in found:
        yield base, sorted(base + [(start, 3, end) for start, end, s in parts if s in random])


def _scanned(batches: Iterator[pd.DataFrame], cuts: dict[tuple[int, int], int]) -> Iterator[pd.DataFrame]:
    def listed(spans):
        return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)

    for rows in runs(batches):
        out = []
        for base, spans in spans_of(rows["text"].tolist(), cuts):
            kinds = [kind for _, kind, _ in spans]
            out.append((*(kinds.count(k) for k in range(4)), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
        made = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])
        made.insert(0, "doc_id", rows["doc_id"].astype("Int64").array)
        yield made


def scan(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Spans of secrets in each of ``docs`` (doc_id, text)."""
    cuts = reported_bins(docs, rate)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInPandas(lambda batches: tidied(_scanned(batches, cuts)), SPANS)


def redact(docs: DataFrame, rate: float = FALSE_DISCOVERY, text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a marker of its kind; other columns stay."""
    cuts = reported_bins(docs.select(F.col(text).alias("text")), rate)

    def marked(value: str, spans: list) -> str:
        parts, at = [], 0
        for start, kind, end in spans:
            if end <= at:
                continue
            if start >= at:
                parts += [value[at:start], f"[SECRET:{KINDS[kind]}]"]
            at = end
        return "".join([*parts, value[at:]]) if parts else value

    def cleaned(values: pd.Series) -> pd.Series:
        there, out = values.notna(), values.copy()
        for rows in runs(iter([pd.DataFrame({"text": values[there]})])):
            texts = rows["text"].tolist()
            out.loc[rows.index] = [marked(value, spans) for value, (_, spans) in zip(texts, spans_of(texts, cuts))]
        return out

    return docs.withColumn(text, F.pandas_udf(cleaned, "string")(F.col(text).cast("string")))
