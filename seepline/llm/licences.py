"""Licence notices in documents: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of lines with words; words join across its line ends, and comment marks are
none. Each line is classified on its own first, then the joined runs of the lines left: a notice
may begin and end inside a line and be wrapped at any width. Sparse one- and two-word features of the notices in ``NOTICES`` feed a
multinomial logistic regression in numpy. Its training rows are the notices with words lost,
repeated or surrounded by other text, and as the *unknown* class a bounded sample of corpus
lines and scrambled notices. A temperature and the threshold for a known family are
calibrated on rows kept from the fit. A prediction counts only if the words of a notice of
that family are found in order: the longest common subsequence with the paragraph must cover
``COVERAGE`` of the notice.

Only lines and runs with a *telling* word (one of the notices that is no everyday word) are
scored; the others are unknown by definition. Of the first and last line of a run the ``REACH``
words next to it count, and the lines between have ``REACH`` words at most. NULL text has no paragraphs; repeated rows give
their rows each; ties between families go to the first in ``NOTICES``.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seepline.llm.common import slices, texts

MAX_LINES = 3_000
#: characters of a training line; longer lines are cut, not shortened
PIECE = 2_000
COVERAGE = 0.7
PRECISION = 0.99
_WORDS = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: short public notices by family, fixed values
NOTICES = {
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "licensed under the GNU General Public License, version 2",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "LGPL": (
        "licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD 2-Clause License",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
    ),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC0": ("CC0 1.0 Universal Public Domain Dedication", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
}
#: words of notices that everyday text has too, fixed values
EVERYDAY = frozenset(
    "a all an and any are as at be by can copy for free found from have in is it law may not of on or person possible purpose source that the this to "
    "under use with without work you your v version program file files following conditions met provided should received along at com www http https "
    "1 2 3 4 0 1.0 2.0 2.1 4.0 com org form forms extent above shall included portions obtaining associated except international universal".split()
)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def grams(words: list[str]) -> set[str]:
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


_TEMPLATES = {f: [words_of(n) for n in notices] for f, notices in NOTICES.items()}
FAMILIES = (*NOTICES, "unknown")
TELLING = frozenset(w for ts in _TEMPLATES.values() for t in ts for w in t) - EVERYDAY


#: words of joined lines: twice the longest notice
REACH = 2 * max(len(t) for ts in _TEMPLATES.values() for t in ts)


def coverage(template: list[str], words: list[str]) -> float:
    """Share of the template's words that the paragraph has in the same order."""
    near = [w for w in words if w in set(template)]
    row = [0] * (len(near) + 1)
    for t in template:
        diagonal = 0
        for j, w in enumerate(near, 1):
            diagonal, row[j] = row[j], diagonal + 1 if w == t else max(row[j], row[j - 1])
    return row[-1] / len(template)


def similarity(family: str, words: list[str]) -> float:
    """The best coverage of the family's templates."""
    return max((coverage(t, words) for t in _TEMPLATES.get(family, [])), default=0.0)


@dataclass(frozen=True)
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray  # features and a last row of biases, by family
    temperature: float
    threshold: float

    def probabilities(self, paragraphs: list[list[str]]) -> np.ndarray:
        z = np.tile(self.weights[-1], (len(paragraphs), 1))
        for i, words in enumerate(paragraphs):
            known = [self.vocabulary[g] for g in grams(words) if g in self.vocabulary]
            if known:
                z[i] += self.weights[sorted(known)].sum(axis=0) / np.sqrt(len(known))
        z /= self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def classify(self, paragraphs: list[list[str]]) -> list[tuple[str, float, float]]:
        """Family, probability and template similarity; unknown where either is too low."""
        out = []
        p = self.probabilities(paragraphs) if paragraphs else np.zeros((0, len(FAMILIES)))
        for words, row in zip(paragraphs, p, strict=True):
            k = int(row[:-1].argmax())
            near = similarity(FAMILIES[k], words)
            sure = row[k] >= self.threshold and near >= COVERAGE
            out.append((FAMILIES[k], float(row[k]), near) if sure else ("unknown", float(row[-1]), near))
        return out


def joined(lines: list[list[str]], telling: list[bool]) -> list[tuple[int, int, list[str]]]:
    """First line, last line and words of the runs of two lines or more, without a line that has
    no words, in which enough words of some notice stand near a telling word."""
    out = []
    ends = [i for i, w in enumerate(lines) if not w]
    for begin, end in zip([0, *(e + 1 for e in ends)], [*ends, len(lines)], strict=True):
        if end - begin < 2 or not any(telling[begin:end]):
            continue
        for i in range(begin, end - 1):
            words, told, runs = lines[i][-REACH:], telling[i], []
            inner = 0
            for j in range(i + 1, end):
                told = told or telling[j]
                if told:
                    runs.append((i, j, words + lines[j][:REACH]))
                inner += len(lines[j])
                if inner > REACH:
                    break
                words = words + lines[j]
            # the last run holds all the others
            if runs and _may_hold(runs[-1][2]):
                out += [r for r in runs if _may_hold(r[2])]
    return out


def _may_hold(words: list[str]) -> bool:
    """Whether some notice has enough of its words here, in any order."""
    held = set(words)
    return any(sum(w in held for w in t) >= COVERAGE * len(t) for ts in _TEMPLATES.values() for t in ts)


def apart(runs: list[tuple[int, int, tuple[str, float, float]]]) -> list[tuple[int, int, tuple[str, float, float]]]:
    """The runs that stay: the most similar first, then the shortest; two share an end line at most."""
    out: list = []
    for run in sorted(runs, key=lambda r: (-r[2][2], r[1] - r[0], r[0])):
        if all(run[1] <= o[0] or run[0] >= o[1] for o in out):
            out.append(run)
    return sorted(out, key=lambda r: r[:2])


def training_rows(lines: list[list[str]], seed: int = 7, variants: int = 24) -> list[tuple[list[str], int]]:
    """Varied notices with their family, and lines and scrambled notices as unknown."""
    rng = random.Random(seed)
    rows = []
    for k, templates in enumerate(_TEMPLATES.values()):
        for t in templates:
            for _ in range(variants):
                words = [w for w in t if rng.random() > 0.06]
                if rng.random() < 0.4 and lines:
                    side = rng.choice(lines)
                    cut = rng.randint(0, min(12, len(side)))
                    words = side[:cut] + words if rng.random() < 0.5 else words + side[:cut]
                if words:
                    rows.append((words, k))
            for _ in range(variants // 4):
                words = rng.sample(t, max(1, len(t) // rng.randint(3, 5)))
                rows.append((words, len(FAMILIES) - 1))
    rows += [(w, len(FAMILIES) - 1) for w in lines]
    rng.shuffle(rows)
    return rows


def fit(lines: list[list[str]], steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Softmax regression by Adam on four fifths of the rows; the rest calibrates."""
    lines = [w for w in lines if max((similarity(f, w) for f in NOTICES), default=0) < COVERAGE]
    rows = training_rows(lines)
    vocabulary = {g: i for i, g in enumerate(sorted({g for ts in _TEMPLATES.values() for t in ts for g in grams(t)}))}
    x = np.zeros((len(rows), len(vocabulary) + 1), np.float32)
    for i, (words, _) in enumerate(rows):
        known = sorted({vocabulary[g] for g in grams(words) if g in vocabulary})
        x[i, known] = 1 / np.sqrt(max(1, len(known)))
        x[i, -1] = 1
    y = np.array([k for _, k in rows])
    held = np.arange(len(rows)) % 5 == 0
    goal = np.eye(len(FAMILIES), dtype=np.float32)[y]
    w = np.zeros((x.shape[1], len(FAMILIES)), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    fx, fy = x[~held], goal[~held]
    for step in range(1, steps + 1):
        z = fx @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = fx.T @ (p - fy) / len(fx) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    z, own = x[held] @ w, y[held]

    def soft(t: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=lambda t: -np.log(soft(t)[np.arange(len(own)), own] + 1e-12).mean())
    p = soft(temperature)[:, :-1]
    best, top = p.argmax(axis=1), p.max(axis=1)
    # the lowest threshold from which on known families are right often enough
    levels = [t for t in np.linspace(0.3, 0.95, 14) if (best[top >= t] == own[top >= t]).mean() >= PRECISION] if len(own) else []
    return Model(vocabulary, w.astype(np.float64), float(temperature), float(min(levels, default=0.95)))


def train(docs: DataFrame, max_lines: int = MAX_LINES, piece: int = PIECE) -> Model:
    """Fit with at most ``max_lines`` corpus lines as the unknown class; the draw is by hash of
    the document's id, spread over about as many documents. A line of more than ``piece``
    characters counts as several: it is cut, and every piece of it may be drawn."""
    rows = texts(docs)
    total = rows.count()
    grain = 1_000_000
    draw = F.pmod(F.xxhash64(F.lit(21), "doc_id", F.char_length("text")), F.lit(grain)) < F.lit(int(grain * min(1.0, max_lines / max(1, total))))
    line = rows.where(draw).select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length("line"), F.lit(1)), F.lit(piece))
    line = line.withColumn("start", F.explode(starts)).select("doc_id", F.substring("line", F.col("start"), F.lit(piece)).alias("line"))
    line = line.where(F.col("line").rlike("[A-Za-z0-9]")).select("line", F.xxhash64(F.lit(22), "doc_id", "line").alias("at"))
    got = sorted(r["line"] for r in line.orderBy("at", "line").limit(max_lines).collect())
    return fit([w for w in (words_of(t) for t in got) if w])


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, line, start, end, family, probability, similarity``: one row for each line or
    joined run of lines with a confirmed family; ``line`` is the first one, and positions are code
    points of the text."""
    schema = "doc_id long, line int, start long, end long, family string, probability double, similarity double"
    telling = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, TELLING))) + r")\b", re.IGNORECASE)

    def notices(text: str) -> list[tuple]:
        lines = text.split("\n")
        told = [telling.search(line) is not None for line in lines]
        alone = [k for k, t in enumerate(told) if t]
        words = [words_of(line) for line in lines]
        got = [(k, k, c) for k, c in zip(alone, model.classify([words[k] for k in alone]), strict=True) if c[0] != "unknown"]
        for k, _, _ in got:
            words[k], told[k] = [], False
        runs = joined(words, told)
        some = [(i, j, c) for (i, j, _), c in zip(runs, model.classify([w for _, _, w in runs]), strict=True) if c[0] != "unknown"]
        at = np.cumsum([0, *(len(line) + 1 for line in lines)]).tolist()
        return [(i, at[i], at[j + 1] - 1, *c) for i, j, c in sorted(got + apart(some), key=lambda r: r[:2])]

    def found(batches):
        for part in slices(batches):
            out = []
            for doc, text in zip(part["doc_id"], part["text"], strict=True):
                if telling.search(text):
                    out += [(doc, *r) for r in notices(text)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "line", "start", "end", "family", "probability", "similarity"]
            )

    return texts(docs).mapInArrow(found, schema)
