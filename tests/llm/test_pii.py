"""Personal data against the plain patterns."""

import hashlib
import re

from loglens.llm import pii

TEXTS = [None, "", "mail é to a.b+c@x-y.example.com, or x@y or @z.com or q@w.e_r@t.yu", "1.2.3.4 256.1.1.1 001.002.003.255 1.2.3.4.5.6.7.8 1.2.3",
         "card 4637089055456426 4637-0890 5545 6426 4637089055456427 46370890554564261234567 1 2", "call +1 (437) 555-0689. or +49 1 +1234567 +123456789012345 6",
         "iban DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 bank", "GB82WEST12345698765433 DE89370400440532013000x", "ssn 123-45-6789 and 123-45-6789",
         "é" * 50 + " 123-45-6789 😀 a@b.c", "5105 1051-0510 5100 5 5"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


CHECKS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
          ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans long")
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i, text in enumerate(TEXTS):
        spans = [(k, m.start(), m.end()) for k, p, ok in CHECKS for m in re.finditer(p, text or "") if ok(m[0])]
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert found[i].spans.startswith(listed)
        assert found[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), text
        assert [found[i][f"n_{k}"] for k, _, _ in CHECKS] == [sum(s[0] == k for s in spans) for k, _, _ in CHECKS]


def test_checksums_and_context_decide_on_the_rest(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    more = {r.doc_id: [s for s in r.spans.split(",") if s[:4] in ("iban", "idnu")] for r in pii.personal_data(docs).collect()}
    assert more[6] == ["iban:5:32", "iban:36:58"] and more[7] == []
    assert more[8] == ["idnum:4:15", "idnum:20:31"] and more[9] == []


def test_runs_of_one_kind_of_character_take_no_long_time(spark):
    texts = ["a" * 200_000, "1" * 200_000, "1 " * 100_000, "+1" * 100_000, "1." * 100_000, "A1" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(pii.personal_data(docs).collect()) == len(texts)


def test_no_rows(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_many_matches_in_one_text(spark):
    text = "é a@b.cd +12345678 " * 3001 + "x"
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_email, row.n_phone) == (3001, 3001)
    assert row.spans.split(",")[:3001] == [f"email:{19 * i + 2}:{19 * i + 8}" for i in range(3001)]
