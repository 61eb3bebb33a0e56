"""Tokens, similar lines and document ids."""

from collections import Counter
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, SparkSession, functions as F

from loglens import schema as S
from loglens.functions.paths import _col

# A single character, not a blank, that separates two words: anything but letters, marks, digits and "_",
# unless it stands between two letters (. : ' ...) or between two digits (. , ; ' ...). No part of these
# patterns repeats a group, so no input, however long, makes the matcher recurse.
_DELIMITER = (r"[^\p{L}\p{M}\p{N}_ ]"
              r"(?<![\p{L}\p{M}][.:'’·](?=[\p{L}\p{M}]))"
              r"(?<!\p{N}[.,;'’](?=\p{N}))")
_IDEOGRAPH = r"([\p{IsHan}\p{IsHiragana}])"
# A run of word characters without a letter or digit. An ideograph is a word of its own, so it ends a run.
_IN_WORD = r"[\p{L}\p{M}\p{N}_&&[^\p{IsHan}\p{IsHiragana}]]"
_HOLLOW = rf"[_\p{{M}}](?<!{_IN_WORD}[_\p{{M}}])[_\p{{M}}]*+(?!{_IN_WORD})"
# May hold a word that has to be cut.
_LONG = r"(?:^|\s)\S{256}"
# With more words than this, only the probes are tested as substrings, not how many of all words are there.
_COUNTED_WORDS = 24


def tokenize(text) -> Column:
    """Lower-cased words of a text, in order and with repeats.

    Words follow Unicode word boundaries: ``bycast.log``, ``25.27`` and ``won't`` stay whole, hyphens and
    colons between digits separate, ideographs are one word each, and words longer than 255 characters
    are cut into pieces of 255.
    """
    text = _col(text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    apart = F.when(ascii_only, text).otherwise(F.regexp_replace(text, _IDEOGRAPH, " $1 "))
    blanked = F.regexp_replace(F.lower(apart), _DELIMITER, " ")
    # Splitting on a blank needs no pattern; split() would compile one for every row.
    words = F.array_remove(F.split(blanked, " ", -1), "")
    real = F.filter(words, lambda w: w.rlike(r"[\p{L}\p{N}]"))
    pieces = F.flatten(F.transform(
        real,
        lambda w: F.when(F.char_length(w) <= S.LONGEST_TOKEN, F.array(w)).otherwise(
            F.transform(F.sequence(F.lit(0), F.floor((F.char_length(w) - 1) / S.LONGEST_TOKEN).cast("int")),
                        lambda i: F.substr(w, i * S.LONGEST_TOKEN + 1, F.lit(S.LONGEST_TOKEN))))))
    unusual = (((~ascii_only | text.contains("_")) & text.rlike(_HOLLOW))
               | ((F.octet_length(text) > S.LONGEST_TOKEN) & text.rlike(_LONG)))
    return F.when(unusual, pieces).otherwise(words)


def snippet_tokens(spark: SparkSession, text: str) -> list[str]:
    """Tokens of one literal text, cut by the same expression as the lines."""
    return spark.range(1).select(tokenize(F.lit(text)).alias("t")).first()["t"]


def required_matches(n: int, pct: int = S.MATCH_PERCENT) -> int:
    return max(1, n * pct // 100)


def required_matches_col(n: Column, pct: int = S.MATCH_PERCENT) -> Column:
    return F.greatest(F.lit(1), F.floor(n * pct / 100)).cast("int")


def weighted_hits(line_tokens: Column, words: Column, weights: Column) -> Column:
    """Sum of ``weights[w]`` over the distinct ``words`` found among a line's tokens."""
    return F.aggregate(F.array_intersect(words, line_tokens), F.lit(0),
                       lambda acc, w: acc + F.element_at(weights, w))


def similar_to(spark: SparkSession, text: str, pct: int = S.MATCH_PERCENT,
               message="message", tokens=None) -> Column:
    """True where at least ``pct`` percent of the snippet's tokens (repeats counted) occur in the line.

    ``tokens`` names a stored token column; without it the line is split on the fly, but only where a
    cheap substring test finds one of the snippet's words that a similar line cannot do without.
    """
    counted = Counter(snippet_tokens(spark, text))
    n = sum(counted.values())
    if not n:
        return F.lit(False)
    need = required_matches(n, pct)
    words = F.array(*[F.lit(w) for w in counted])

    def matches(line_tokens):
        # line_tokens is named once, so a line is split once
        if max(counted.values()) == 1:
            return F.size(F.array_intersect(words, line_tokens)) >= need
        weights = F.create_map(*[F.lit(x) for pair in counted.items() for x in pair])
        return weighted_hits(line_tokens, words, weights) >= need

    if tokens is not None:
        return matches(_col(tokens))
    # A similar line holds enough of the words as substrings, and one of any set of words that together
    # weigh more than the n - need it may miss. Both are cheap to test before the line is split.
    probes, weight = [], 0
    for word in sorted(counted, key=lambda w: (-len(w), w)):
        probes.append(word)
        weight += counted[word]
        if weight > n - need:
            break
    lowered = F.lower(_col(message))
    possible = reduce(or_, (lowered.contains(word) for word in probes))
    if len(counted) <= _COUNTED_WORDS:
        present = reduce(add, (F.when(lowered.contains(w), F.lit(k)).otherwise(0) for w, k in counted.items()))
        possible = possible & (present >= need)
    return F.when(possible, matches(tokenize(message))).otherwise(False)


def doc_id(relpath, line_no) -> Column:
    """``relpath/line_no``; from 512 characters on, its SHA-256, which is the same in every run."""
    full = F.concat_ws("/", _col(relpath), _col(line_no).cast("string"))
    return F.when(F.char_length(full) >= S.DOC_ID_LIMIT, F.sha2(full, 256)).otherwise(full)
