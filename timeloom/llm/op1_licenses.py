"""Licence scan of paragraphs.

A multinomial logistic regression over sparse word n-grams (single words and
pairs) gives each paragraph a licence family or the class ``unknown``.
A line is a paragraph; so is a run of lines, each with a word of licences, that
is mostly one notice or has none in a single line, so that notices may be
wrapped.
The classifier is trained on paragraphs made from the templates below, cut,
thinned and set among other words, against paragraphs of a bounded sample of
the corpus.  A temperature calibrates it; it is fitted on examples of templates
that a first training didn't see.  A family needs probability PROBABLE.  A
predicted family is confirmed by comparing the paragraph with its templates:
the share of word pairs that the shorter of the two has in common with the
other must reach LIKENESS; a template of few words is compared with single
sentences, and the longer of the two counts.

Corner cases: a null or empty text has no paragraphs; a paragraph without any
n-gram of the model is unknown; blank lines are skipped; a very long text or
line is read whole; several families in a document are all reported; ties go to
the family that is listed first; repeated rows get equal results; with an empty
corpus the model is trained on the templates alone, and an empty table gives no
rows.  Only doc_id and text are read; columns to carry that are called matches
are for the caller to rename (``common.set_aside``).
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm import common

PROBABLE, LIKENESS = 0.5, 0.6
#: About so many documents, chosen by hash, give lines of class unknown, at most PER_DOCUMENT each, chosen by hash too.
SAMPLE, PER_DOCUMENT = 1500, 4
#: Words drawn from each of those lines, to stand in and around the made-up notices; lines of three characters or fewer teach nothing.
FILLER = 20
#: Templates of up to so many word pairs are compared with single sentences.
SHORT = 4
UNKNOWN = "unknown"
WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[.;!?](?:\s+|$)")

# Notices of common licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "public-domain": [
        "Released into the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 Example Company. All rights reserved.",
        "This document is confidential and proprietary. Unauthorized copying, distribution or use is strictly prohibited.",
    ],
}
FAMILIES = [UNKNOWN, *TEMPLATES]
# Sentences with words of licences that grant nothing.
OTHERS = [
    "He lost his driving license last year.",
    "The general public was free to use the library.",
    "All tables were reserved.",
    "A new version of the software was published under a different name.",
    "The work of the Apache people is described in this source.",
    "The permission to copy files was granted by the person in charge.",
    "They studied at MIT and published a program.",
    "Rights and conditions of use are discussed in common law.",
]


def grams(words: list[str]) -> list:
    return [*words, *zip(words, words[1:])]


def pairs(words: list[str]) -> frozenset:
    return frozenset(zip(words, words[1:])) or frozenset(words)


COMPARE = {family: [pairs(WORD.findall(t.lower())) for t in texts] for family, texts in TEMPLATES.items()}


def likeness(text: str, family: str) -> float:
    """The best share of word pairs in common with a template of the family."""
    low = text.lower()
    own = pairs(WORD.findall(low))
    best = 0.0
    for template in COMPARE[family]:
        if len(template) > SHORT:
            best = max(best, len(own & template) / max(1, min(len(own), len(template))))
        elif not template.isdisjoint(own):
            sentences = (pairs(WORD.findall(x)) for x in SENTENCE.split(low))
            best = max(best, *(len(x & template) / max(1, len(x), len(template)) for x in sentences))
    return best


@dataclass
class Model:
    weights: dict  # n-gram -> weight of every family
    offset: np.ndarray
    temperature: float = 1.0

    def __post_init__(self):
        self.telling = frozenset(g for g in self.weights if isinstance(g, str))

    def raw(self, words: list[str]) -> np.ndarray:
        rows = [self.weights[g] for g in set(grams(words)) if g in self.weights]
        return self.offset + (np.sum(rows, axis=0) if rows else 0.0)

    def predict(self, words: list[str]) -> tuple[str, float]:
        z = self.raw(words) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return (FAMILIES[best] if p[best] >= PROBABLE else UNKNOWN), float(p[best])


@dataclass
class Example:
    words: list[str]
    family: int
    template: int  # its number among the family's, -1 without


def examples(background: list[str], seed: int = 7) -> list[Example]:
    """Paragraphs made from the templates, and others."""
    rng = random.Random(seed)
    other = [WORD.findall(t.lower()) for t in background if all(likeness(t, f) < 0.5 for f in TEMPLATES)]
    other = [w for w in other if w]
    draw = random.Random(seed)
    filler = [w for words in other for w in draw.sample(words, min(FILLER, len(words)))] or ["text", "word", "line"]
    out = [Example(w, 0, -1) for w in other] + [Example(WORD.findall(t.lower()), 0, -1) for t in OTHERS for _ in range(5)]
    for k, family in enumerate(FAMILIES[1:], 1):
        for i, text in enumerate(TEMPLATES[family]):
            words = WORD.findall(text.lower())
            for turn in range(24):
                made = list(words)
                if turn % 3 == 1 and len(made) > 12:  # a wrapped line of it
                    at = rng.randrange(len(made) - 8)
                    made = made[at : at + rng.randint(8, 16)]
                if turn % 3 == 2:
                    made = [w for w in made if rng.random() > 0.08] or made
                if turn % 4 == 3:
                    made = rng.choices(filler, k=rng.randint(1, 6)) + made + rng.choices(filler, k=rng.randint(0, 4))
                out.append(Example(made, k, i))
            for _ in range(3):  # its words without their order, too few to grant anything
                out.append(Example(rng.sample(words, min(3, len(words))) + rng.choices(filler, k=8), 0, -1))
    return out


def probabilities(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(made: list[Example], steps: int = 250, ridge: float = 2e-4) -> Model:
    """The regression; n-grams are those that are telling of licences, or rare outside them."""
    licence, plain = Counter(), Counter()
    for x in made:
        (licence if x.family else plain).update(set(grams(x.words)))
    n1, n0 = sum(x.family > 0 for x in made), max(1, sum(x.family == 0 for x in made))
    telling = lambda g: licence[g] >= 5 and licence[g] / n1 > 3 * (plain[g] + 1) / n0 or licence[g] >= 5 and plain[g] < 0.02 * n0
    single = {g for g in licence if isinstance(g, str) and telling(g)}
    kept = sorted(single) + sorted(g for g in licence if not isinstance(g, str) and telling(g) and (g[0] in single or g[1] in single))
    index = {g: i for i, g in enumerate(kept)}
    rows = [sorted({index[g] for g in grams(x.words) if g in index}) for x in made]
    y = np.array([x.family for x in made])
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    by_col = np.argsort(col, kind="stable")
    some, at_doc = np.unique(doc, return_index=True)
    used, at_col = np.unique(col[by_col], return_index=True)
    b = np.log(np.bincount(y, minlength=len(FAMILIES)) / len(y) + 1e-3)
    w = np.zeros((len(kept), len(FAMILIES)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    truth = np.eye(len(FAMILIES))[y]
    for t in range(1, steps + 1):
        z = np.tile(b, (len(rows), 1))
        if len(some):
            z[some] += np.add.reduceat(w[col], at_doc)
        miss = truth - probabilities(z)
        g = -ridge * w
        if len(used):
            g[used] += np.add.reduceat(miss[doc[by_col]], at_col) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b = b + 0.5 * miss.mean(0)
    return Model({g: w[i] for g, i in index.items()}, b)


def train(background: list[str]) -> Model:
    """Fit on all examples, with the temperature at which a fit without some templates judges those and spare lines best."""
    made = examples(background)
    # The last template of families of three or more, and a fifth of the rest of class unknown.
    spare = [len(TEMPLATES[FAMILIES[x.family]]) == x.template + 1 > 2 if x.family else i % 5 == 4 for i, x in enumerate(made)]
    first = fit([x for x, s in zip(made, spare) if not s])
    held = [x for x, s in zip(made, spare) if s]
    z, y = np.array([first.raw(x.words) for x in held]), np.array([x.family for x in held])
    cost = lambda temperature: -np.log(probabilities(z / temperature)[np.arange(len(z)), y] + 1e-12).mean()
    model = fit(made)
    model.temperature = float(min((0.5 * 1.1**i for i in range(30)), key=cost))
    return model


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    n = max(1, docs.count())
    rows = docs.where(F.col("text").isNotNull()).where(common.unit_hash(F.col("doc_id"), F.lit("licence")) * n < F.lit(float(sample)))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 3)
    chosen = F.slice(F.array_sort(F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("line")))), 1, PER_DOCUMENT)
    return train(sorted(r[0] for r in rows.select(F.explode(chosen).alias("x")).select("x.line").collect()))


def judge(model: Model, text: str) -> tuple[str, float, float] | None:
    """Family, probability and likeness of a text with a confirmed family."""
    words = WORD.findall(text.lower())
    if model.telling.isdisjoint(words):
        return None
    family, p = model.predict(words)
    if family == UNKNOWN:
        return None
    like = likeness(text, family)
    return (family, p, like) if like >= LIKENESS else None


def like_templates(text: str, family: str) -> float:
    """The share of a text's word pairs that one template of the family has."""
    own = pairs(WORD.findall(text.lower()))
    return max(len(own & t) for t in COMPARE[family]) / max(1, len(own))


def judge_run(model: Model, lines: list[tuple[int, str]]) -> list[tuple[int, int, str, float, float]]:
    """Of successive lines, each with its start: the whole if most of it is a notice, else each notice among them, else the whole if it holds one."""
    whole = judge(model, "\n".join(x for _, x in lines)) if len(lines) > 1 else None
    if not (whole and like_templates("\n".join(x for _, x in lines), whole[0]) >= LIKENESS):
        found = [(at, at + len(x), *judged) for at, x in lines if (judged := judge(model, x))]
        if found or not whole:
            return found
    inside = [i for i, (_, x) in enumerate(lines) if like_templates(x, whole[0]) > 0]
    first, last = lines[min(inside, default=0)], lines[max(inside, default=-1)]
    return [(first[0], last[0] + len(last[1]), *whole)]


def scan_text(model: Model, text: str) -> list[tuple[int, int, str, float, float]]:
    """start, end, family, probability and likeness of every paragraph with a confirmed family."""
    if model.telling.isdisjoint(WORD.findall(text.lower())):
        return []
    out, run, at = [], [], 0
    for line in text.split("\n"):
        if not model.telling.isdisjoint(WORD.findall(line.lower())):
            run.append((at, line))
        elif run:
            out += judge_run(model, run)
            run = []
        at += len(line) + 1
    return out + judge_run(model, run)


MATCH = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("likeness", T.DoubleType())]))


def scan(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` with the confirmed licence paragraphs of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["start", "end", "family", "probability", "likeness"]

    def make():
        model = shared.value

        def run(texts):
            return {"matches": [[dict(zip(names, m)) for m in scan_text(model, t)] for t in texts]}

        return run

    return common.map_text(docs, list(keep), make, [("matches", MATCH)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    rows = scan(docs, learn(docs), "doc_id")
    families = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["family"])))
    return rows.select(
        "doc_id",
        F.array_join(families, ",").alias("families"),
        F.size("matches").cast("long").alias("n_paragraphs"),
        F.get("matches", F.lit(0))["start"].alias("first_start"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["probability"])), F.lit(0.0)).alias("score"),
    )
