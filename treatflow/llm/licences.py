"""Licence scans: a trained paragraph classifier whose findings are confirmed against templates."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatflow.llm.common import text_chunks, without

WORD = re.compile(r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]")
UNKNOWN = "unknown"
REACH = 6        # words without a known n-gram that a notice may hold on end
# fixed values: families of licences, the names and identifiers of their versions, and notices that give no name
NAMES = {
    "agpl": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0"],
    "bsd": ["BSD 2-Clause License", "BSD 3-Clause License", "modified BSD License"],
    "boost": ["Boost Software License, Version 1.0"],
    "cc-by": ["CC BY 3.0", "CC BY 4.0", "Creative Commons Attribution 3.0 Unported License", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 3.0", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License",
                 "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "epl": ["Eclipse Public License 1.0", "Eclipse Public License v2.0"],
    "gpl": ["GNU General Public License, version 2", "GNU General Public License version 2 only", "GNU General Public License version 2 or later",
            "GNU General Public License, version 3", "GNU General Public License version 3 or later", "GNU GPL v2", "GNU GPL v3"],
    "isc": ["ISC License"],
    "lgpl": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License, version 3", "GNU LGPL v3"],
    "mit": ["MIT License"],
    "mpl": ["Mozilla Public License, version 1.1", "Mozilla Public License, version 2.0"],
    "unlicense": ["Unlicense"],
    "zlib": ["zlib License"],
}
IDENTIFIERS = {
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "apache": ["Apache-2.0"], "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "boost": ["BSL-1.0"],
    "cc-by": ["CC-BY-4.0"], "cc-by-nc": ["CC-BY-NC-4.0"], "cc-by-sa": ["CC-BY-SA-4.0"], "cc0": ["CC0-1.0"], "epl": ["EPL-1.0", "EPL-2.0"],
    "gpl": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"], "isc": ["ISC"],
    "lgpl": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"], "mit": ["MIT"], "mpl": ["MPL-2.0"],
    "unlicense": ["Unlicense"], "zlib": ["Zlib"],
}
NOTICES = {
    "agpl": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"],
    "apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "boost": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation"],
    "cc0": ["To the extent possible under law, the author has waived all copyright. CC0 1.0 Public Domain Dedication."],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
    "gpl": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "provided that the above copyright notice and this permission notice appear in all copies"],
    "lgpl": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without written permission."],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "zlib": ["This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages"],
}
TEMPLATES = {family: [
    *(f"{form} {name}" for name in NAMES.get(family, []) for form in ("Licensed under the", "Released under")),
    *(f"SPDX-License-Identifier: {i}" for i in IDENTIFIERS.get(family, [])), *NOTICES.get(family, []),
] for family in sorted({*NAMES, *IDENTIFIERS, *NOTICES})}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(words: list[str]) -> list[str]:
    """Word pairs and triples."""
    return [*map(" ".join, zip(words, words[1:])), *map(" ".join, zip(words, words[1:], words[2:]))]


@dataclass(frozen=True)
class Model:
    """Sparse logistic regression over the n-grams of the templates; class 0 is ``unknown``."""

    families: list[str]
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    templates: dict[str, list[frozenset]]

    @cached_property
    def known(self) -> frozenset:
        return frozenset(w for g in self.vocabulary for w in g.split(" "))

    def classify(self, words: list[str]) -> tuple[str, float, float, bool] | None:
        """(family, probability, similarity to its nearest template, confirmed), or None for unknown."""
        found = Counter(self.vocabulary[g] for g in grams(words) if g in self.vocabulary)
        if not found:
            return None
        z = self.bias.copy()
        for f, n in found.items():
            z += self.weights[f] * min(n, 3)
        z = (z - z.max()) / self.temperature
        p = np.exp(z) / np.exp(z).sum()
        best = int(p.argmax())
        if best == 0 or p[best] < self.threshold:
            return None
        family = self.families[best]
        own = frozenset(grams(words))
        similarity = max(len(own & t) / len(t) for t in self.templates[family])
        return family, float(p[best]), similarity, similarity >= 0.5


    def find(self, text: str) -> list[tuple]:
        """(start, length, *class) of the whole lines of each notice, by place.

        Words are read through the line ends of a paragraph, which ends at a blank line.  A notice is a stretch of words
        in which known word pairs are at most ``REACH`` words apart.  Its lines that are confirmed on their own are
        notices of their own; what lies between those is judged as one.
        """
        hits: dict[tuple, tuple] = {}
        words: list[str] = []
        lines: list[tuple[int, int, int]] = []
        at = 0
        for line in [*text.split("\n"), ""]:
            if line and not line.isspace():
                words += words_of(line)
                lines.append((at, len(line), len(words)))
            elif lines:
                for first, last, *hit in self._notices(words, lines):
                    start = lines[first][0]
                    place = start, lines[last][0] + lines[last][1] - start
                    hits.setdefault((*place, hit[0]), (*place, *hit))
                words, lines = [], []
            at += len(line) + 1
        return list(hits.values())

    def _notices(self, words: list[str], lines: list[tuple[int, int, int]]) -> Iterator[tuple]:
        """(first line, last line, *class) of each notice of a paragraph."""
        if len(self.known.intersection(words)) < 2:
            return
        pairs = [i for i, w in enumerate(words[:-1]) if w in self.known and f"{w} {words[i + 1]}" in self.vocabulary]
        ends = [n for _, _, n in lines]
        low = 0
        for high in range(1, len(pairs) + 1):
            if high < len(pairs) and pairs[high] - pairs[high - 1] <= REACH:
                continue
            a, b = pairs[low], pairs[high - 1] + 2
            low = high
            # the stretch by lines: (line, first word, end)
            parts = []
            line = bisect_right(ends, a)
            while a < b:
                parts.append((line, a, min(b, ends[line])))
                a, line = max(a, ends[line]), line + 1
            parts = [p for p in parts if p[1] < p[2]]
            alone = [self.classify(words[x:y]) for _, x, y in parts]
            held: list[int] = []
            for i in range(len(parts) + 1):
                if i < len(parts) and not (alone[i] and alone[i][3]):
                    held.append(i)
                    continue
                if len(held) > 1 and (joined := self.classify(words[parts[held[0]][1]:parts[held[-1]][2]])):
                    yield parts[held[0]][0], parts[held[-1]][0], *joined
                else:
                    yield from ((parts[k][0], parts[k][0], *alone[k]) for k in held if alone[k])
                held = []
                if i < len(parts):
                    yield parts[i][0], parts[i][0], *alone[i]


def variants(text: str, background: list[list[str]], rng: np.random.Generator, n: int) -> list[list[str]]:
    """Training paragraphs from a template: words dropped or changed, set between words of the corpus."""
    words = words_of(text)
    made = [words]
    for _ in range(n):
        kept = [w for w in words if rng.random() > 0.06]
        around = background[rng.integers(len(background))] if background else []
        cut = int(rng.integers(len(around) + 1))
        size = int(rng.integers(0, 12))
        made.append(around[max(0, cut - size):cut] + kept + around[cut:cut + size])
    return made


def train(background: list[str], templates: dict[str, list[str]] = TEMPLATES, copies: int = 60, rounds: int = 200,
          seed: int = 7) -> Model:
    """Fit on varied templates and on paragraphs of the corpus, then calibrate on one fifth held back.

    Paragraphs of the corpus that hold a third of a template are not taken for the unknown class.  Mixed
    snippets of several templates, which name no licence, are unknown too.
    """
    rng = np.random.default_rng(seed)
    families = [UNKNOWN, *sorted(templates)]
    shapes = {f: [frozenset(grams(words_of(t))) for t in ts] for f, ts in templates.items()}
    vocabulary = {g: i for i, g in enumerate(sorted(set().union(*[t for ts in shapes.values() for t in ts])))}
    other = []
    for words in map(words_of, background):
        own = vocabulary.keys() & grams(words)
        if not own or not any(len(t & own) * 3 >= len(t) for ts in shapes.values() for t in ts):
            other.append(words)
    rows = [(w, 0) for w in other]
    for family, texts in templates.items():
        for text in texts:
            # a variant that lost every n-gram names nothing
            rows += [(v, families.index(family)) for v in variants(text, other, rng, copies) if any(g in vocabulary for g in grams(v))]
            words = words_of(text)
            for _ in range(copies // 4):
                a = int(rng.integers(len(words)))
                snippet = words[a:a + int(rng.integers(1, 4))]
                # half a template would be confirmed
                if not any(2 * len(t.intersection(grams(snippet))) >= len(t) for ts in shapes.values() for t in ts):
                    rows.append((snippet, 0))
    order = rng.permutation(len(rows))
    x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    y = np.zeros(len(rows), dtype=np.int64)
    of_corpus = order < len(other)
    for at, i in enumerate(order.tolist()):
        words, y[at] = rows[i]
        for g, n in Counter(g for g in grams(words) if g in vocabulary).items():
            x[at, vocabulary[g]] = min(n, 3)
    held = len(rows) // 5
    share = np.bincount(y[held:], minlength=len(families))
    per_row = (1 / np.maximum(share, 1))[y[held:]] * (len(y) - held) / len(families)
    w, b = np.zeros((len(vocabulary), len(families)), dtype=np.float32), np.zeros(len(families), dtype=np.float32)
    target = np.eye(len(families), dtype=np.float32)[y[held:]]
    per_row = per_row.astype(np.float32)
    step_w, step_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        z = x[held:] @ w + b
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        slope = (target - p) * per_row[:, None]
        # steps keep nine tenths of the one before
        step_w = np.float32(0.9) * step_w + x[held:].T @ slope / np.float32(len(slope)) - np.float32(1e-5) * w
        step_b = np.float32(0.9) * step_b + slope.mean(axis=0)
        w += step_w
        b += step_b
    z = x[:held] @ w + b
    target = y[:held]

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), target]).mean())

    temperature = min((0.1 * 1.25**i for i in range(25)), key=loss)
    s = z / temperature
    p = np.exp(s - s.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    # at the threshold at most one in a hundred paragraphs of the corpus with any known n-gram passes
    wrong = p[of_corpus[:held] & (x[:held].sum(axis=1) > 0)][:, 1:].max(axis=1)
    threshold = max(0.5, float(np.quantile(wrong, 0.99)) if len(wrong) else 0.5)
    return Model(families, vocabulary, w, b, temperature, threshold, shapes)


def fit(docs: DataFrame, max_paragraphs: int = 2000, max_chars: int = 2000, text: str = "text") -> Model:
    """Train with ``max_paragraphs`` distinct lines, the first by a hash, of 20 to ``max_chars`` characters as background.

    Hashes are counted down first, so a line of very many copies is one of them; fewer lines are all taken.
    """
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("p")).filter(F.length("p").between(20, max_chars)).select(
        "p", F.xxhash64("p").alias("o"))
    last = lines.select("o").distinct().orderBy("o").limit(max_paragraphs).agg(F.max("o")).first()[0]
    # equal hashes of different lines keep the smaller
    sample = lines.filter(F.col("o") <= F.lit(last)).groupBy("o").agg(F.min("p").alias("p")).orderBy("o")
    return train([r["p"] for r in sample.select("p").toLocalIterator()])


def scan_licences(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``licences`` (confirmed families, sorted) and ``licence_spans`` of every paragraph that is not unknown.

    Paragraphs end at blank lines and are read whole, through their line ends; a span covers whole lines.  Null and empty
    texts have none.  Columns of the result's names are replaced, others and repeated rows stay.
    """
    kept = without(docs, "licences", "licence_spans")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = next(c for c in kept.columns if c.lower() == text.lower())
    fields = [("start", pa.int32()), ("length", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
              ("similarity", pa.float64()), ("confirmed", pa.bool_())]
    spans = pa.list_(pa.struct(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = [n for n, _ in fields]
        for chunk in text_chunks(batches, column, 8 << 20):
            families, found = [], []
            for value in chunk.column(column):
                hits = [dict(zip(names, hit)) for hit in m.find(value.as_py() or "")]
                found.append(hits)
                families.append(sorted({h["family"] for h in hits if h["confirmed"]}))
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(families, pa.list_(pa.string())), pa.array(found, spans)],
                                             [*chunk.schema.names, "licences", "licence_spans"])

    row = T.StructType([T.StructField(n, t) for n, t in zip([n for n, _ in fields], (
        T.IntegerType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()))])
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("licences", T.ArrayType(T.StringType())),
                                              T.StructField("licence_spans", T.ArrayType(row))]))
