"""Licences of files: sparse TF-IDF cosine to templates, and inheritance from directories.

Each line, each paragraph and the whole text of a file is a sparse vector of word counts times
inverse template frequencies, compared to every licence template by its cosine. A unit whose cosine
reaches ``SIMILARITY`` declares the licence; a file whose whole text does is a licence file and
speaks for its directory. Files without a declaration take that of the nearest directory above them
that has one, by a join on path prefixes.

Notices inside longer text are found by windows: of as many words as a notice, at every place of a
text where one holds an anchor word. Whole texts are besides compared to whole licences, as vectors
of word pairs, if they have at least half the words; pairs, as single words of long English texts
are all alike.

Only units with an anchor word are turned into vectors: words outside the anchors carry less than
``SIMILARITY`` of any template's length, so a unit without an anchor cannot reach it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, ready_for_python

SIMILARITY = 0.7

#: Public licence notices by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    ),
)

#: Common words, taken as anchors only where the others do not suffice.
COMMON = frozenset("a an and any are as at be by can for from if in is it may not of on one or that the this to under use was with you".split())


def words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def idf_table(templates=TEMPLATES) -> tuple[dict[str, float], float]:
    """Inverse template frequency of each word, and that of a word in no template."""
    held = Counter(w for _, t in templates for w in set(words(t)))
    return {w: math.log((1 + len(templates)) / (1 + n)) + 1 for w, n in held.items()}, math.log(1 + len(templates)) + 1


def vectors(templates=TEMPLATES) -> list[tuple[int, str, str, float]]:
    """(template, licence, word, weight) of unit length."""
    idf, _ = idf_table(templates)
    rows = []
    for k, (licence, text) in enumerate(templates):
        weights = {w: n * idf[w] for w, n in Counter(words(text)).items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        rows += [(k, licence, w, x / norm) for w, x in sorted(weights.items())]
    return rows


def anchors(templates=TEMPLATES, similarity: float = SIMILARITY) -> list[str]:
    """Words of which a unit must have one to reach the similarity, weighty ones first and common ones last."""
    chosen: set[str] = set()
    rows = vectors(templates)
    for k in range(len(templates)):
        own = sorted(((w not in COMMON, x, w) for t, _, w, x in rows if t == k), reverse=True)
        left = sum(x * x for _, x, w in own if w not in chosen)
        for _, x, w in own:
            if math.sqrt(left) < similarity - 1e-9:
                break
            if w not in chosen:
                chosen.add(w)
                left -= x * x
    return sorted(chosen)


def pairs(own: list[str]) -> Counter:
    return Counter(zip(own, own[1:], strict=False))


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    """(licence, whole text) of the folder ``texts``; there is none of the Creative Commons licences."""
    return tuple((f.stem, f.read_text("utf-8")) for f in sorted((Path(__file__).parent / "texts").glob("*.txt")))


def pair_vectors(texts) -> tuple[dict, float, list[tuple[str, int, dict]]]:
    """Weights of word pairs, that of a pair in no text, and (licence, words, unit vector) of each text."""
    counts = [pairs(words(t)) for _, t in texts]
    held = Counter(p for c in counts for p in c)
    idf = {p: math.log((1 + len(texts)) / (1 + n)) + 1 for p, n in held.items()}
    sides = []
    for (licence, text), count in zip(texts, counts, strict=True):
        norm = math.sqrt(sum((n * idf[p]) ** 2 for p, n in count.items()))
        sides.append((licence, len(words(text)), {p: n * idf[p] / norm for p, n in count.items()}))
    return idf, math.log(1 + len(texts)) + 1, sides


def pair_anchors(sides, similarity: float) -> list[str]:
    """Words of which a whole text must have one to reach the similarity to a whole licence."""
    chosen: set[str] = set()
    for _, _, vector in sides:
        left = {p: x for p, x in vector.items() if not chosen & set(p)}
        while math.sqrt(sum(x * x for x in left.values())) >= similarity - 1e-9:
            gains: Counter = Counter()
            for p, x in left.items():
                for w in set(p):
                    gains[w] += x * x
            best = max(gains, key=lambda w: (w not in COMMON, gains[w], w))
            chosen.add(best)
            left = {p: x for p, x in left.items() if best not in p}
    return sorted(chosen)


def best_whole(own: list[str], idf: dict, other: float, sides, similarity: float) -> tuple[float, str] | None:
    """The whole licence most like a whole text."""
    fit = [s for s in sides if 2 * len(own) >= s[1]]
    if not fit:
        return None
    count = pairs(own)
    norm = math.sqrt(sum((n * idf.get(p, other)) ** 2 for p, n in count.items())) or 1.0
    near = [(round(sum(n * idf[p] * v[p] for p, n in count.items() if p in v) / norm, 9), licence) for licence, _, v in fit]
    return max((x for x in near if x[0] >= similarity), default=None)


def notices(templates, similarity: float) -> list[tuple[str, int, dict, set]]:
    """(licence, words, unit vector, anchors) of each template."""
    chosen, rows = set(anchors(templates, similarity)), vectors(templates)
    own = [{w: x for t, _, w, x in rows if t == k} for k in range(len(templates))]
    return [(licence, len(words(text)), v, chosen & v.keys()) for (licence, text), v in zip(templates, own, strict=True)]


def best_window(own: list[str], idf: dict, other: float, sides, similarity: float) -> tuple[float, str] | None:
    """The notice most like any run of as many words."""
    best = None
    marks = {w for s in sides for w in s[3]}
    at = [(i, w) for i, w in enumerate(own) if w in marks]
    for licence, n, vector, wanted in sides:
        spans: list[list[int]] = []  # first and last starts of windows with an anchor
        for i, w in at:
            if w in wanted:
                lo, hi = max(0, i - n + 1), min(i, len(own) - n)
                if spans and lo <= spans[-1][1] + 1:
                    spans[-1][1] = max(hi, spans[-1][1])
                elif lo <= hi:
                    spans.append([lo, hi])
        for lo, hi in spans:
            count: Counter = Counter()
            dot = square = 0.0
            for i in range(lo, hi + n):
                w = own[i]
                x = idf.get(w, other)
                square += x * x * (2 * count[w] + 1)
                dot += x * vector.get(w, 0.0)
                count[w] += 1
                if i - n >= lo:
                    w = own[i - n]
                    x = idf.get(w, other)
                    count[w] -= 1
                    square -= x * x * (2 * count[w] + 1)
                    dot -= x * vector.get(w, 0.0)
                if i - lo + 1 >= n:
                    found = (round(dot / math.sqrt(square), 9), licence)
                    if found[0] >= similarity and (best is None or found > best):
                        best = found
    return best


def best_unit(own: list[str], idf: dict, other: float, sides, similarity: float) -> tuple[float, str] | None:
    """The notice most like a unit as a whole."""
    count = Counter(own)
    norm = math.sqrt(sum((n * idf.get(w, other)) ** 2 for w, n in count.items())) or 1.0
    known = {w: n * idf[w] for w, n in count.items() if w in idf}
    near = [(round(sum(x * v[w] for w, x in known.items() if w in v) / norm, 9), licence) for licence, _, v, _ in sides]
    return max((x for x in near if x[0] >= similarity), default=None)


def declared(scratch: Scratch, files: DataFrame, templates=TEMPLATES, similarity: float = SIMILARITY, full=None) -> DataFrame:
    """(path, kind, licence, similarity): the best unit of each kind, ``file`` or ``header``."""
    ready_for_python(files.sparkSession)
    idf, other = idf_table(templates)
    pair_idf, pair_other, sides = pair_vectors(full_texts() if full is None else full)
    chosen = anchors(templates, similarity)
    shared = files.sparkSession.sparkContext.broadcast(((idf, other, notices(templates, similarity)), (pair_idf, pair_other, sides)))
    pattern = r"(?i)(?<![a-z0-9])(" + "|".join(sorted({*chosen, *pair_anchors(sides, similarity)})) + r")(?![a-z0-9])"

    def judged(text: str, notice, whole) -> Iterator[tuple[str, tuple[float, str] | None]]:
        own, marks = words(text), set(chosen)
        yield "file", best_whole(own, *whole, similarity)
        if marks.isdisjoint(own):
            return
        yield "file", best_unit(own, *notice, similarity)
        yield "header", best_window(own, *notice, similarity)
        for unit in {*text.split("\n"), *re.split(r"\n[ \t\r]*\n", text)}:
            part = own if unit == text else words(unit)
            if not marks.isdisjoint(part):
                yield "header", best_unit(part, *notice, similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                best: dict[str, tuple[float, str]] = {}
                for kind, found in judged(text, *shared.value):
                    if found:
                        best[kind] = max(found, best.get(kind, found))
                rows += [(path, kind, *found) for kind, found in best.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "kind", "similarity", "licence"])

    found = files.filter(F.col("text").rlike(pattern)).select("path", "text")
    found = found.mapInArrow(run, "path string, kind string, similarity double, licence string")
    best = found.groupBy("path", "kind").agg(F.max(F.struct("similarity", "licence")).alias("b"))
    return scratch.cut(best.select("path", "kind", "b.licence", "b.similarity"))


def directories(path: Column) -> Column:
    """Every directory above a path, the root as an empty string, as (directory, depth)."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.struct(F.concat_ws("/", F.slice(parts, 1, i)).alias("directory"), i.alias("depth")),
    )


def scan(files: DataFrame, templates=TEMPLATES, similarity: float = SIMILARITY) -> DataFrame:
    """``files`` (path, text, and others) with licence, origin, similarity and declared_in.

    ``origin`` is ``file``, ``header`` or ``inherited``, or null where no licence was found. Rows
    that share a path are one file with all their texts; of several declarations the most similar
    counts, then the larger name. A null path has no directories, and its rows are matched by a
    null-safe comparison. Null and empty texts declare nothing. Empty tables give empty results.
    """
    scratch = Scratch(files.sparkSession)
    own = [c for c in files.columns if c not in ("text", "licence", "origin", "similarity", "declared_in")]
    said = declared(scratch, files, templates, similarity)
    by_file = said.groupBy("path").agg(F.max(F.struct((F.col("kind") == "file").cast("int").alias("whole"), "similarity", "licence", "kind")).alias("s"))
    speaks = said.filter("kind = 'file' AND path IS NOT NULL")
    directory = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    held = speaks.groupBy(directory.alias("directory")).agg(F.max(F.struct("similarity", "licence")).alias("d"))
    above = files.select("path").distinct().join(by_file, "path", "left_anti").filter("path IS NOT NULL")
    above = above.select("path", F.inline(directories(F.col("path"))))
    nearest = above.join(held, "directory").groupBy("path").agg(F.max(F.struct("depth", "directory", "d")).alias("n"))
    direct = by_file.select("path", F.col("s.licence").alias("licence"), F.col("s.kind").alias("origin"), F.col("s.similarity").alias("similarity"), F.lit(None).cast("string").alias("declared_in"))
    taken = nearest.select("path", F.col("n.d.licence").alias("licence"), F.lit("inherited").alias("origin"), F.col("n.d.similarity").alias("similarity"), F.col("n.directory").alias("declared_in"))
    answer = direct.unionByName(taken).withColumnRenamed("path", "_path")
    joined = files.select(*own).join(answer, F.col("path").eqNullSafe(F.col("_path")), "left")
    return joined.select(*own, "licence", "origin", "similarity", "declared_in")


def corpus_files(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents as ``source/lang/id`` and pages as ``host/path``, with their markup taken for line breaks."""
    from seqloom.llm.url_rules import host_of, path_of

    docs = documents.select(
        F.lit("document").alias("kind"),
        F.col("doc_id").alias("id"),
        F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        "text",
    )
    url = F.col("url")
    web = pages.select(
        F.lit("page").alias("kind"),
        F.col("page_id").alias("id"),
        F.concat(host_of(url), path_of(url)).alias("path"),
        F.regexp_replace("html", "<[^>]*>", "\n").alias("text"),
    )
    return docs.unionByName(web)
