"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Positions come from SQL functions alone: a text split at a pattern's matches gives the gaps between them, and
running lengths of gaps and matches give starts. Only DataFrame functions run.

The kinds email, ip, card and phone are always reported when their pattern and check hold; iban (mod-97) and idnum
only if the score, with the words before the span, reaches the threshold.

Defined cases: a null or empty text has no spans. Rows that repeat a doc_id, or have none, are scanned each on their
own. An empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Scores are in hundredths.
THRESHOLD = 60
CONTEXT_CHARS = 40
CONTEXT_BONUS = 30
# Matches are put together in blocks, so that adding one copies no more than a block.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    name: str
    #: Finds at the same places as the plain pattern of the contract, without trying a run of characters twice.
    pattern: str
    check: str
    score: int
    context: str
    always: bool = True


_DIGITS = "regexp_replace(x.found, '[^0-9]', '')"
_LUHN = (f"aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + aggregate(array(int(substring({_DIGITS}, -i, 1)) "
         "* (2 - i % 2)), 0, (b, d) -> b + if(d > 9, d - 9, d))) % 10 = 0")
_REMAINDER = ("aggregate(sequence(1, length(regexp_replace(x.found, ' ', ''))), 0, (a, i) -> aggregate(array(instr("
              "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substring(concat(substring(regexp_replace(x.found, ' ', ''), 5), "
              "substring(x.found, 1, 4)), i, 1)) - 1), a, (b, d) -> if(d > 9, b * 100 + d, b * 10 + d) % 97))")

KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 70,
         "mail|contact|write to|reach"),
    Kind("ip", r"[0-9]++(?:\.[0-9]++){3}",
         r"forall(split(x.found, '[.]'), p -> length(regexp_replace(p, '^0+', '')) < 4 "
         r"and coalesce(try_cast(regexp_replace(p, '^0+', '') as int), 0) <= 255)", 50, r"\bip\b|address|server|host"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,}+",
         f"length({_DIGITS}) between 16 and 19 and {_LUHN}", 65, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) between 8 and 15", 50, "phone|call|mobile|fax"),
    Kind("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b",
         f"length(regexp_replace(x.found, ' ', '')) between 15 and 34 and {_REMAINDER} = 1", 65, "iban|account|bank", False),
    Kind("idnum", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "true", 35, r"\bssn\b|social security|identity", False),
]
BASE = [k.name for k in KINDS if k.always]


def _quoted(text: str) -> str:
    return "r'" + text + "'"


def _spans(kind: Kind) -> Column:
    """Array of (kind, start, end, score) in order of start."""
    pattern = _quoted(kind.pattern)
    kind_of_spans = "array<struct<start: int, end: int, found: string>>"
    one_more = """(a, x) -> named_struct('at', a.at + char_length(x.`0`) + coalesce(char_length(x.`1`), 0),
        'out', if(x.`1` is null, a.out, concat(a.out, array(named_struct('start', a.at + char_length(x.`0`),
            'end', a.at + char_length(x.`0`) + char_length(x.`1`), 'found', x.`1`)))))"""
    blocks = f"""aggregate(array(arrays_zip(split(_text, {pattern}, -1), regexp_extract_all(_text, {pattern}, 0))),
        cast(array() as array<array<struct<`0`: string, `1`: string>>>),
        (none, z) -> transform(sequence(0, (size(z) - 1) div {BLOCK}), i -> slice(z, i * {BLOCK} + 1, {BLOCK})))"""
    placed = f"""aggregate({blocks}, cast(named_struct('at', 0, 'out', array()) as struct<at: int, out: array<{kind_of_spans}>>),
        (all, block) -> aggregate(array(aggregate(block,
            cast(named_struct('at', all.at, 'out', array()) as struct<at: int, out: {kind_of_spans}>), {one_more})),
            all, (before, b) -> named_struct('at', b.at, 'out', concat(before.out, array(b.out)))),
        all -> flatten(all.out))"""
    near = (f"substring(_text, greatest(x.start - {CONTEXT_CHARS}, 0) + 1, least(x.start, {CONTEXT_CHARS})) "
            f"rlike {_quoted('(?i)' + kind.context)}")
    scored = f"""transform(filter({placed}, x -> {kind.check}), x -> named_struct('kind', '{kind.name}', 'start', x.start,
        'end', x.end, 'score', {kind.score} + if({near}, {CONTEXT_BONUS}, 0)))"""
    if not kind.always:
        scored = f"filter({scored}, x -> x.score >= {THRESHOLD})"
    none = "cast(array() as array<struct<kind: string, start: int, end: int, score: int>>)"
    return F.expr(f"if(_text rlike {pattern}, {scored}, {none})")


def with_spans(docs: DataFrame, text: str = "text", to: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, score) added; places count characters, ends are exclusive."""
    kinds = {f"_{k.name}": _spans(k) for k in KINDS}
    found = docs.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumns(kinds)
    return found.withColumn(to, F.concat(*kinds)).drop("_text", *kinds)


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and spans of each kind for each of ``docs`` (doc_id, text)."""
    found = with_spans(docs.select("doc_id", "text"))

    def listed(spans: str) -> Column:
        return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")

    base = "filter(spans, x -> x.kind in ({}))".format(", ".join(f"'{k}'" for k in BASE))
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"),
                        F.expr("array_join(transform(spans, x -> cast(x.score as string)), ',')").alias("scores"))
