"""License scans: TF-IDF cosine to license headers and whole license texts, and inheritance by directory.

Headers are compared with every line and with every window of a file's words that is as long as the header, so that
a wrapped header, or one amid other text, counts as it stands. Whole license texts are compared with windows as long
as they are; a shorter file is one window. Words of the templates are weighted by their rarity over all files; any
other word counts as if it were in no file. A tag SPDX-License-Identifier says itself which licenses it means. Of
windows that overlap the likeliest counts, whole license texts before headers. A file's own license is the likeliest
that is left, if it is like enough; the cosine given is that of the line as a whole where the line is like enough.
A file that is named as a license file, or most of whose text is license text, gives its license to its directory; a
file without one of its own takes that of the nearest directory above it.

A template is passed over for a file only where the words they share can't reach the least cosine, whatever the window.

Defined cases: a null or empty text has no license of its own; a null path lies in the root directory, whose name
is empty. Where templates tie, the first by name is taken; where license files of a directory disagree, the most
frequent license, then the first by name. Rows that repeat a path are judged each by its own text. An empty table
gives no rows. Columns of the input that aren't named are handed through, unless a result column has their name.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from loglens.llm.common import on_executors, runs
from loglens.session import Staging, join_checked

LEAST_COSINE = 0.6
# Common words alone make long texts alike, so whole license texts have to be liker.
LEAST_TEXT_COSINE = 0.9
# A line or window is compared if it shares so many different words with some template's vocabulary.
LEAST_SHARED_WORDS = 2
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][^/]*)?$"
LICENSE_SHARE = 0.5

TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


# Lower-cased words; dots within numbers stay.
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)", re.I)
SPDX_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*\+?")
FOUND = "own_license string, cosine double, line int, license_chars long"


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def license_texts() -> list[tuple[str, str]]:
    """Names and whole texts of licenses. Read by the driver."""
    return [(path.stem, path.read_text("utf-8")) for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]


def template_table(spark: SparkSession, templates=tuple(TEMPLATES)) -> DataFrame:
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")


class Templates:
    """Templates (license, text) of one kind, with their words weighted."""

    def __init__(self, templates: list[tuple[str, str]], rarity: dict[str, float], unknown: float, least: float, lines: bool):
        self.least, self.lines = least, lines           # lines: whether whole lines are compared too
        cut = [(name, Counter(words(text))) for name, text in templates]
        cut = [(name, counts) for name, counts in cut if counts]
        self.names, self.sizes = [name for name, _ in cut], [counts.total() for _, counts in cut]
        self.at = {term: i for i, term in enumerate(sorted({term for _, counts in cut for term in counts}))}
        self.weight = np.array([rarity[term] for term in self.at] + [unknown])      # all other words have the last
        self.vectors = np.zeros((len(cut), len(self.weight)))
        for i, (_, counts) in enumerate(cut):
            for term, n in counts.items():
                self.vectors[i, self.at[term]] = n * rarity[term]
        self.lengths = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.shares = self.vectors ** 2 / (self.lengths ** 2)[:, None]

    def reachable(self, vocabulary: set[str]) -> list[int]:
        """Templates that share enough with a text of this vocabulary for the least cosine (Cauchy-Schwarz)."""
        shared = [self.at[term] for term in vocabulary & self.at.keys()]
        if len(shared) < LEAST_SHARED_WORDS:
            return []
        return np.flatnonzero(self.shares[:, shared].sum(axis=1) >= self.least ** 2 - 1e-6).tolist()

    def numbered(self, terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each word a number, equal for equal words, and its weight."""
        others: dict[str, int] = {}
        ids = np.array([self.at[t] if t in self.at else len(self.at) + others.setdefault(t, len(others)) for t in terms], np.int64)
        return ids, self.weight[np.minimum(ids, len(self.at))]

    def cosines(self, template: int, ids: np.ndarray, weights: np.ndarray, size: int) -> Iterator[tuple[int, float]]:
        """Where windows of ``size`` words begin that are like the template, and their cosines."""
        known = len(self.at)
        gain = weights * self.vectors[template][np.minimum(ids, known)]             # the last is 0
        before = lambda x: np.concatenate([[0.0], np.cumsum(x)])                    # noqa: E731
        dots, squares = ((s := before(x))[size:] - s[:-size] for x in (gain, weights * weights))
        need = self.least * self.lengths[template]
        open_ = np.flatnonzero(dots >= need * np.sqrt(squares) * (1 - 1e-6))        # were no word repeated
        last, many, square = -size, Counter(), 0.0
        for begin in open_.tolist():
            if begin - last >= size:
                last, many, square = begin, Counter(), 0.0
                fresh, gone = range(begin, begin + size), range(0)
            else:
                fresh, gone = range(last + size, begin + size), range(last, begin)
                last = begin
            for i in gone:
                many[ids[i]] -= 1
                square -= weights[i] ** 2 * (2 * many[ids[i]] + 1)
            for i in fresh:
                square += weights[i] ** 2 * (2 * many[ids[i]] + 1)
                many[ids[i]] += 1
            cosine = round(float(dots[begin] / math.sqrt(square) / self.lengths[template]), 6)
            if cosine >= self.least and sum(n > 0 and i < known for i, n in many.items()) >= LEAST_SHARED_WORDS:
                yield begin, cosine


def _spdx(text: str) -> Iterator[tuple[float, str, int, int]]:
    for tag in SPDX.finditer(text):
        for part in SPDX_ID.finditer(re.sub(r"(?i)\bwith\s+\S+", " ", tag[1])):
            name = re.sub(r"(-only|-or-later|\+)$", "", part[0].rstrip(".-"))
            if name and name.lower() not in ("and", "or", "none", "noassertion"):
                yield -1.0, name, tag.start(), tag.end()


def license_of(text: str, kinds: list[Templates]) -> tuple[str, float, int, int] | None:
    """License, cosine and line of ``text``, and how many of its characters are license text."""
    tags = list(_spdx(text)) if "spdx" in text.lower() else []
    vocabulary = set(words(text))
    open_ = [(kind, kind.reachable(vocabulary)) for kind in kinds]
    if not tags and not any(templates for _, templates in open_):
        return None
    lowered = text.lower()
    if len(lowered) != len(text):
        text = lowered
    ends = [m.start() for m in re.finditer("\n", text)] + [len(text)]
    line_starts = [0, *(e + 1 for e in ends[:-1])]
    terms, begins, stops = [], [], []
    for m in WORD.finditer(lowered):
        terms.append(m[0]), begins.append(m.start()), stops.append(m.end())
    line_of = np.searchsorted(ends, begins, side="left")
    edges = np.searchsorted(line_of, np.arange(len(ends) + 1)).tolist()
    found, whole = [(0, cosine, name, a, b) for cosine, name, a, b in tags], {}
    for kind, templates in open_:
        if not templates or not terms:
            continue
        ids, weights = kind.numbered(terms)
        for i in templates:
            name, size = kind.names[i], min(kind.sizes[i], len(terms))
            for begin, cosine in kind.cosines(i, ids, weights, size):
                found.append((not kind.lines, -cosine, name, begins[begin], stops[begin + size - 1]))
            for line in range(len(ends)) if kind.lines else ():
                a, b = edges[line], edges[line + 1]
                for _, cosine in kind.cosines(i, ids[a:b], weights[a:b], b - a) if b > a else ():
                    found.append((False, -cosine, name, line_starts[line], ends[line]))
                    whole[line, name] = max(cosine, whole.get((line, name), 0.0))
    if not found:
        return None
    taken: list[tuple] = []                     # by place
    for is_text, cosine, name, a, b in sorted(found, key=lambda s: (not s[0], *s[1:])):
        at = bisect.bisect_left(taken, (a,))
        if (at == len(taken) or taken[at][0] >= b) and (at == 0 or taken[at - 1][1] <= a):
            taken.insert(at, (a, b, cosine, name))
    best = min((cosine, name, int(np.searchsorted(ends, a, side="left")), b) for a, b, cosine, name in taken)
    cosine, name, line, stop = best
    if stop <= ends[line]:                      # within one line, which may be like the license as a whole
        cosine = -whole.get((line, name), -cosine)
    spans = [(a, b) for a, b, *_ in taken] + [(line_starts[at], ends[at]) for at, _ in whole]
    chars, reached = 0, 0
    for a, b in sorted(spans):
        chars, reached = chars + max(0, b - max(a, reached)), max(reached, b)
    return name, -cosine, line, chars


def _vocabulary_counts(batches: Iterator[pd.DataFrame], vocabulary: frozenset[str]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for rows in runs(batches):
        for text in rows["text"]:
            counts.update(vocabulary.intersection(words(text)))
    yield pd.DataFrame({"term": list(counts.keys()), "df": list(counts.values())}).astype({"term": object, "df": "int64"})


def _licenses(batches: Iterator[pd.Series], kinds: list[Templates]) -> Iterator[pd.DataFrame]:
    none = (None, None, None, None)
    for batch in batches:
        found = [license_of(text, kinds) or none for text in batch]
        yield pd.DataFrame(found, columns=["own_license", "cosine", "line", "license_chars"]).astype(
            {"own_license": object, "cosine": "Float64", "line": "Int32", "license_chars": "Int64"})


def own_licenses(files: DataFrame, templates: list[tuple[str, str]], texts: list[tuple[str, str]], least: float = LEAST_COSINE) -> DataFrame:
    """``files`` (text, others) without text, with _chars and FOUND added; those without a license of their own have nulls."""
    others = [c for c in files.columns if c != "text"]
    files = on_executors(files).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    vocabulary = frozenset(term for _, text in [*templates, *texts] for term in words(text))
    n = files.count()
    df = files.select("text").mapInPandas(lambda batches: _vocabulary_counts(batches, vocabulary), "term string, df long")
    df = {r["term"]: r["df"] for r in df.groupBy("term").agg(F.sum("df").alias("df")).collect()}      # the templates' words
    rarity = {term: math.log((n + 1.0) / (df.get(term, 0) + 1.0)) + 1.0 for term in vocabulary}
    unknown = math.log(n + 1.0) + 1.0
    kinds = [Templates(templates, rarity, unknown, least, True), Templates(texts, rarity, unknown, max(least, LEAST_TEXT_COSINE), False)]
    of = F.pandas_udf(lambda batches: _licenses(batches, kinds), FOUND, F.PandasUDFType.SCALAR_ITER)
    return files.select(*others, F.char_length("text").alias("_chars"), of("text").alias("_own")).select(*others, "_chars", "_own.*")


def scan(files: DataFrame, templates: DataFrame | None = None, least: float = LEAST_COSINE) -> DataFrame:
    """``files`` (path, text, others) without text, with own_license, cosine, line, from_directory and license."""
    spark = files.sparkSession
    staging = Staging(spark)
    templates = template_table(spark) if templates is None else templates
    named = [(r["license"], r["text"]) for r in templates.orderBy("template").collect()]
    results = ["own_license", "cosine", "line", "from_directory", "license"]
    others = [c for c in files.columns if c not in ("text", "row", *results)]
    found = staging.table(own_licenses(files.select("text", *others), named, license_texts(), least), "found")
    directory = F.regexp_replace(F.coalesce("path", F.lit("")), r"/?[^/]*$", "")
    found = found.withColumn("_directory", directory)
    files_of = found.where(F.col("own_license").isNotNull() & (
        F.coalesce("path", F.lit("")).rlike(LICENSE_FILE) | (F.col("license_chars") >= LICENSE_SHARE * F.col("_chars"))))
    given = (files_of.groupBy("_directory", "own_license").agg(F.count("*").alias("n")).groupBy("_directory")
             .agg(F.min(F.struct((-F.col("n")).alias("by"), "own_license")).alias("best"))
             .select(F.col("_directory").alias("above"), F.col("best.own_license").alias("given")))
    # directories, not files, look upwards: each has its own ancestors, itself first
    depth = F.when(F.col("_directory") == "", 0).otherwise(F.size(F.split("_directory", "/")))
    parts = found.select("_directory").distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), depth)))
    above = parts.withColumn("above", F.when(F.col("depth") == 0, "").otherwise(F.expr("substring_index(_directory, '/', depth)")))
    nearest = (join_checked(above, given, "above").groupBy("_directory")
               .agg(F.max(F.struct("depth", "above", "given")).alias("nearest"))
               .select("_directory", F.col("nearest.above").alias("from_directory"), F.col("nearest.given").alias("given")))
    joined = join_checked(found, nearest, "_directory", "left")
    own_free = F.col("own_license").isNull()
    return joined.select(*others, "own_license", "cosine", "line", F.when(own_free, F.col("from_directory")).alias("from_directory"),
                         F.coalesce("own_license", "given").alias("license"))


def scan_documents(docs: DataFrame) -> DataFrame:
    """``scan`` of documents as files of the directory <source>/<lang>."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("none"))
    path = F.concat_ws("/", part("source"), part("lang"), F.concat(part("doc_id"), F.lit(".txt")))
    return scan(docs.select("doc_id", path.alias("path"), "text"))
