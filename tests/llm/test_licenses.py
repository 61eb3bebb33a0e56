"""License scans against cosines computed one by one."""

import math
import random
import re
from collections import Counter

from loglens.llm import licenses

FILES = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.txt", "some text " * 9 + "\nLicensed under CC BY-NC 4.0.\nmore"), ("a/b/y.txt", "plain"),
         ("a/b/c/z.txt", "license is a word of the public"), ("q/long.txt", "word " * 5000 + "\nLicensed under the Apache License, Version 2.0."),
         ("q/short", "This work is licensed under the GNU General Public License, version 3.\n"), ("q/d/e/f.txt", None), (None, "rootless"), ("top.txt", ""),
         ("a/b/noise.txt", "far more text " * 9 + "\nsee Released under the MIT License. by somebody"), ("q/d/e/f.txt", None)]


def words(text):
    return re.findall(r"[^\W_]+(?:\.[0-9]+)*", (text or "").lower())


def brute_force():
    vocabulary = {w for _, t in licenses.TEMPLATES for w in words(t)}
    n, df = len(FILES), Counter(w for _, t in FILES for w in set(words(t)) & vocabulary)
    idf = lambda w: math.log((n + 1) / (df[w] + 1)) + 1 if w in vocabulary else math.log(n + 1) + 1
    vector = lambda text: {w: c * idf(w) for w, c in Counter(words(text)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = []
    for _, text in FILES:
        best = []
        for line, content in enumerate((text or "").split("\n")):
            v = vector(content)
            if len(v.keys() & vocabulary) < licenses.LEAST_SHARED_WORDS:
                continue
            for name, template in licenses.TEMPLATES:
                t = vector(template)
                cosine = round(sum(x * t.get(w, 0) for w, x in v.items()) / length(v) / length(t), 6)
                if cosine >= licenses.LEAST_COSINE:
                    best.append((-cosine, name, line))
        out.append((min(best)[1], -min(best)[0]) if best else (None, None))
    return out


def test_own_licenses_and_inheritance(spark):
    files = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(FILES)], "i long, path string, text string, license string")
    rows = {r.i: r for r in licenses.scan(files).collect()}
    assert len(rows) == len(FILES)
    for i, (name, cosine) in enumerate(brute_force()):
        assert rows[i].own_license == name, (i, rows[i])
        assert cosine is None or abs(rows[i].cosine - cosine) < 1e-5
    assert (rows[2].license, rows[2].from_directory) == ("MIT", "a") and (rows[3].license, rows[3].from_directory) == ("MIT", "a")
    assert rows[1].license == "CC-BY-NC-4.0" and rows[1].from_directory is None
    assert (rows[6].license, rows[6].from_directory) == ("GPL-3.0", "q")
    assert rows[7].license is None and rows[8].license is None


def test_the_root_directory_gives_its_license_to_all(spark):
    files = spark.createDataFrame([("COPYING", "Released under the MIT License.\n" + "x " * 500), ("d/e", "y"), (None, "z")], "path string, text string")
    assert {r.license for r in licenses.scan(files).collect()} == {"MIT"}


def test_no_rows(spark):
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).collect() == []


GPL_2 = """/*
 * Copyright (C) 2020 John Doe
 *
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 */
int main(void) { return 0; }"""
INLINE = "This file came with the parser. Released under the MIT License. Ask the authors for other terms of use please."
MIT_TEXT = dict(licenses.license_texts())["MIT"]


def test_wrapped_inline_and_tagged_headers_and_whole_texts(spark):
    gpl_3 = dict(licenses.license_texts())["GPL-3.0"]
    cases = [("gpl/a.c", GPL_2, "GPL-2.0"), ("b.txt", INLINE, "MIT"), ("c.c", "/* Released under the MIT License. Copyright (c) 2020 John Doe */", "MIT"),
             ("d.c", "// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), ("e.c", "# SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note OR MIT)", "GPL-2.0"),
             ("f.c", "/* SPDX-License-Identifier: Zlib */", "Zlib"),
             ("g.c", "Licensed under\n// the Apache License,\n// Version 2.0.\ncode code code", "Apache-2.0"),
             ("m/LICENSE", "Copyright (c) 2020 John Doe\n\n" + MIT_TEXT, "MIT"), ("m/n.c", "int y;", None),
             ("t/whole", "Copyright (c) 2021 Jane Roe\n\n" + MIT_TEXT.replace("\n", "\n * "), "MIT"), ("t/u.c", "int z;", None),
             ("g3/COPYING", gpl_3, "GPL-3.0"), ("p.txt", "the program is free and the terms of use are the usual ones of the house", None)]
    cases += [(f"{name}/LICENSE", "A preface of the house.\n\n" + text, name) for name, text in licenses.license_texts()]
    cases += [(f"prose/{i}", f"nothing of note {i} " * 20, None) for i in range(40)]
    files = spark.createDataFrame([(p, t) for p, t, _ in cases], "path string, text string")
    rows = {r.path: r for r in licenses.scan(files).collect()}
    assert {p: rows[p].own_license for p, _, _ in cases} == {p: own for p, _, own in cases}
    assert rows["gpl/a.c"].cosine > 0.9 and rows["b.txt"].cosine == 1
    assert rows["m/n.c"].license == "MIT" and rows["t/u.c"].license == "MIT" and rows["t/u.c"].from_directory == "t"


def test_windows_are_those_of_brute_force():
    draw = random.Random(5)
    templates = [("A", "alpha beta gamma delta"), ("B", "beta beta gamma epsilon the of")]
    rarity = {w: draw.uniform(1, 6) for _, t in templates for w in words(t)}
    kind = licenses.Templates(templates, rarity, 7.0, 0.6, True)
    weight = lambda w: rarity.get(w, 7.0)
    length = lambda c: math.sqrt(sum((n * weight(w)) ** 2 for w, n in c.items()))
    hits = 0
    for _ in range(60):
        terms = [draw.choice([*rarity, *rarity, "x", "y"]) for _ in range(60)]
        for i, (_, template) in enumerate(templates):
            t, size, expected = Counter(words(template)), len(words(template)), {}
            for at in range(len(terms) - size + 1):
                c = Counter(terms[at:at + size])
                cosine = round(sum(n * t[w] * weight(w) ** 2 for w, n in c.items()) / length(c) / length(t), 6)
                if cosine >= 0.6 and len(c.keys() & rarity.keys()) >= licenses.LEAST_SHARED_WORDS:
                    expected[at] = cosine
            found = dict(kind.cosines(i, *kind.numbered(terms), size))
            assert found.keys() == expected.keys() and all(abs(found[at] - expected[at]) < 2e-6 for at in found)
            assert not found or i in kind.reachable(set(terms))
            hits += len(found)
    assert hits > 100
