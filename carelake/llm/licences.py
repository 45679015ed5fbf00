"""Licence scans: a paragraph classifier trained here, confirmed against templates."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, in_batches, take, whole_text

# Sentences by which the licences of each family are told.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "MIT License",
        "The MIT License (MIT)",
        "License: MIT",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.",
        "Apache License, Version 2.0",
        "License: Apache-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU GPL v3 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "GNU General Public License",
        "License: GPL-3.0",
        "GPL-2.0-or-later",
        "GPL-3.0-only",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "GNU Lesser General Public License",
        "License: LGPL-3.0",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD 2-Clause License",
        "BSD 3-Clause License",
        "License: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License Version 2.0",
        "License: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    ],
    "agpl": [
        "GNU Affero General Public License",
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "License: AGPL-3.0",
        "AGPL-3.0-only",
    ],
    "epl": [
        "Eclipse Public License 2.0",
        "Made available under the terms of the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
        "License: EPL-2.0",
    ],
    "isc": [
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "SPDX-License-Identifier: ISC",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "all-rights-reserved": [
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without permission.",
    ],
}
# How a statement begins, and what denies it.
STATED = ("Licensed under", "Released under")
DENIALS = (
    "This file is not licensed under", "This work is not released under", "It is no longer licensed under",
    "This is not, and never was, released under", "You may not use this under",
)
UNKNOWN = "unknown"
WORD = re.compile(r"[^\W_]+")
# At most this many paragraphs of the corpus are fitted on as the unknown class.
MAX_UNKNOWN = 3000
# The share of a template's n-grams, and of those that no other family has, that confirm it.
CONFIRMED, TOLD = 0.6, 0.5
# Parts that the templates are dealt into to calibrate on templates not fitted on.
FOLDS = 3


def word_ngrams(text: str) -> set[str]:
    """Single words and pairs of neighbours, without case."""
    return _grams(WORD.findall(text.lower()))


def _grams(words: list[str]) -> set[str]:
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}


@dataclass
class LicenceModel:
    """Sparse weights by n-gram: one number per family; the last one is the unknown class."""

    weights: dict[str, np.ndarray]
    bias: np.ndarray
    temperature: float
    families: list[str]
    templates: list[tuple[int, set[str]]]

    def probabilities(self, grams: set[str]) -> np.ndarray:
        total = self.bias.copy()
        for gram in sorted(grams & self.weights.keys()):
            total += self.weights[gram]
        total = total / self.temperature
        chance = np.exp(total - total.max())
        return chance / chance.sum()

    def labels(self, grams: set[str], least: float) -> list[tuple[str, float, float]]:
        """Every family of the n-grams, with its probability against the unknown class and its share of a template.

        A family counts if most of one of its templates is there. Beside a
        likelier one that counts, most of what that one's templates do not
        explain must be there too: CC BY-NC is not CC BY.
        """
        if grams.isdisjoint(self.weights):
            return []
        chance = self.probabilities(grams)
        against = chance[:-1] / (chance[:-1] + chance[-1])
        found, explained = [], set()
        for family in np.argsort(-chance[:-1], kind="stable").tolist():
            if chance[family] <= chance[-1] or against[family] < least:
                break
            shares = [
                (len(grams & t) / len(t), t)
                for (f, t), telling in zip(self.templates, self.telling, strict=True)
                if f == family and len(grams & telling) >= TOLD * len(telling)
            ]
            shares = [(share, t) for share, t in shares if share >= CONFIRMED]
            if any(len(grams & t - explained) >= max(CONFIRMED * len(t - explained), 1) for _, t in shares):
                found.append((self.families[family], float(against[family]), max(share for share, _ in shares)))
                explained = explained.union(*(t for _, t in shares))
        return found

    @cached_property
    def telling(self) -> list[set[str]]:
        """By template its n-grams that are in no template of another family."""
        families: dict[str, set[int]] = {}
        for family, template in self.templates:
            for gram in template:
                families.setdefault(gram, set()).add(family)
        return [{g for g in template if len(families[g]) == 1} for _, template in self.templates]

    @cached_property
    def pairs(self) -> dict[str, list[int]]:
        """Templates by the word pairs they hold."""
        places: dict[str, list[int]] = {}
        for i, (_, template) in enumerate(self.templates):
            for gram in template:
                if " " in gram:
                    places.setdefault(gram, []).append(i)
        return places

    @cached_property
    def needed(self) -> list[int]:
        """By template the number of word pairs without which it cannot be confirmed."""
        return [max(1, math.ceil(CONFIRMED * len(t)) - sum(" " not in g for g in t)) for _, t in self.templates]

    def wrapped(self, lines: list[list[str]], least: float, known: dict[str, set[int]]) -> list[tuple[int, int, str, float, float]]:
        """Families found in two or more neighbouring lines together: first line, last line, and what ``labels`` gives.

        ``lines`` are the words of a paragraph's lines, ``known`` the lines
        that a family is found in alone. The lines between the first and the
        last hold at most half as many words again as the template.
        """
        words = [w for line in lines for w in line]
        shown: dict[int, set[str]] = {}
        for gram in {f"{a} {b}" for a, b in zip(words, words[1:])} & self.pairs.keys():
            for i in self.pairs[gram]:
                shown.setdefault(i, set()).add(gram)
        tried = []
        for i in sorted(shown):
            if len(shown[i]) < self.needed[i]:
                continue
            family, template = self.templates[i]
            longest = 1.5 * (sum(" " in g for g in template) + 1)
            for first, line in enumerate(lines):
                if template.isdisjoint(line):
                    continue
                got, between, last = template & _grams(line), 0, line[-1]
                for at in range(first + 1, len(lines)):
                    got |= template & _grams([last, *lines[at]])
                    last = lines[at][-1]
                    if len(got) >= CONFIRMED * len(template):
                        tried.append((-len(got) / len(template), at - first, first, at, family))
                    between += len(lines[at])
                    if between > longest:
                        break
        found, taken = [], {name: set(at) for name, at in known.items()}
        for _, _, first, last, family in sorted(tried):
            name, covered = self.families[family], set(range(first, last + 1))
            if covered.isdisjoint(taken.get(name, ())):
                grams = _grams([w for line in lines[first : last + 1] for w in line])
                for label in self.labels(grams, least):
                    if label[0] == name:
                        found.append((first, last, *label))
                        taken.setdefault(name, set()).update(covered)
        return sorted(found)


def _examples(families: list[str]) -> list[tuple[int, str, str]]:
    """Family, template and text: each template as it is, inside other words, with words left out, and next to another one.

    A denied statement is an example of the unknown class.
    """
    made = []
    for family, name in enumerate(families):
        for template in TEMPLATES[name]:
            words = template.split()
            texts = [template, template.upper(), f"Note: {template}", f"{template} See the file for details."]
            for turn in range(6):
                seed = hashlib.sha256(f"{name}:{template}:{turn}".encode()).digest()
                texts.append(" ".join(w for i, w in enumerate(words) if seed[i % 32] > 20))
            made += [(family, template, text) for text in texts]
            for start in STATED:
                if template.startswith(start):
                    made += [(len(families), template, denial + template[len(start) :]) for denial in DENIALS]
    return made


def _fitted(x: np.ndarray, y: np.ndarray, classes: int, steps: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial logistic regression, by Adam over all rows."""
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    target = np.eye(classes, dtype=np.float32)[y]
    for step in range(1, steps + 1):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - target) / len(target)
        for value, grad, i in ((w, x.T @ error + ridge * w / len(target), 0), (b, error.sum(axis=0), 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * grad
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * grad**2
            value -= 0.05 * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-8)
    return w, b


def fit(unknown: list[str], steps: int = 300, ridge: float = 0.02) -> LicenceModel:
    """Multinomial logistic regression on templates, denied statements and unknown paragraphs.

    Probabilities are calibrated by a temperature. It is set on examples whose
    template was held out: templates are dealt into :data:`FOLDS` parts and
    each is judged by a fit on the others. The model itself is fitted on all.
    """
    families = sorted(TEMPLATES)
    examples = _examples(families)
    positive = [(f, word_ngrams(t)) for f, _, t in examples]
    vocabulary = sorted({g for f, grams in positive if f < len(families) for g in grams} | {"not licensed", "not released", "not", "never", "no longer"})
    index = {g: i for i, g in enumerate(vocabulary)}
    # Words that only join a template's meaning are no licence by themselves.
    plain = [(len(families), word_ngrams(t)) for t in unknown] + [(len(families), set())]
    for family, grams in positive:
        if family < len(families):
            plain.append((len(families), set(sorted(g for g in grams if " " not in g)[::3])))
    rows = positive + plain
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for r, (_, grams) in enumerate(rows):
        x[r, [index[g] for g in grams if g in index]] = 1.0
    y = np.array([f for f, _ in rows])
    order = {t: i for i, t in enumerate(dict.fromkeys(t for _, t, _ in examples))}
    fold = np.array([order[t] % FOLDS for _, t, _ in examples] + [i % FOLDS for i in range(len(plain))])
    classes, judged = len(families) + 1, np.zeros((len(rows), len(families) + 1))
    for k in range(FOLDS):
        w, b = _fitted(x[fold != k], y[fold != k], classes, steps // 3, ridge)
        judged[fold == k] = x[fold == k] @ w + b

    def loss(temperature: float) -> float:
        z = judged / temperature
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), y]))

    best = min(np.geomspace(0.25, 16, 49), key=loss)
    w, b = _fitted(x, y, classes, steps, ridge)
    return LicenceModel(
        {g: w[i].astype(float) for g, i in index.items()}, b.astype(float), float(best), families,
        [(f, word_ngrams(t)) for f, name in enumerate(families) for t in TEMPLATES[name]],
    )


def train(docs: DataFrame, max_unknown: int = MAX_UNKNOWN, seed: str = "licence-1") -> LicenceModel:
    """The model, with the unknown class from at most ``max_unknown`` paragraphs.

    They are drawn by a hash from a tenth as many documents, drawn likewise.

    Paragraphs that contain most of a template are licences and not used.
    """
    texts = take(docs, "text").where("text IS NOT NULL")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.xxhash64("text").cast("string")))
    drawn = texts.select(draw.alias("draw"), "text")
    # Each task offers its smallest hashes alone; texts follow for the chosen ones, one of equal texts.
    hashes = drawn.select("draw").orderBy("draw").limit(max(1, max_unknown // 10)).distinct()
    chosen = drawn.join(F.broadcast(hashes), "draw", "left_semi").dropDuplicates(["draw"])
    paragraphs = sorted({p for r in chosen.select("text").collect() for p in r[0].split("\n")}, key=lambda p: hashlib.md5(p.encode()).digest())
    known = [word_ngrams(t) for name in TEMPLATES for t in TEMPLATES[name]]

    def is_licence(paragraph: str) -> bool:
        grams = word_ngrams(paragraph)
        return any(len(grams & t) >= 0.5 * len(t) for t in known)

    return fit([p for p in paragraphs if not is_licence(p)][:max_unknown])


FOUND = "array<struct<family:string,start:long,end:long,probability:double,share:double>>"


def _scan(model: LicenceModel, least: float):
    span = pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("share", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_paragraphs", pa.int64()), ("found", pa.list_(span))])
    # A template is confirmed by most of its n-grams, so its rarest words must show.
    hints = {g for _, t in model.templates for g in t if " " not in g and len(g) > 2}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(hints)

        def rows():
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                at, count, found, paragraph = 0, 0, [], []
                for line in text.split("\n"):
                    count += bool(line.strip())
                    words = WORD.findall(line.lower())
                    if words:
                        paragraph.append((at, at + len(line), words))
                    else:
                        found += spans(paragraph)
                        paragraph = []
                    at += len(line) + 1
                yield doc_id, count, found + spans(paragraph)

        def spans(paragraph: list[tuple[int, int, list[str]]]) -> list[dict]:
            found, alone = [], {}
            for i, (_, _, words) in enumerate(paragraph):
                if not known.isdisjoint(words):
                    for label in model.labels(_grams(words), least):
                        found.append((i, i, *label))
                        alone.setdefault(label[0], set()).add(i)
            if len(paragraph) > 1:
                found += model.wrapped([words for _, _, words in paragraph], least, alone)
            return [
                {"family": family, "start": paragraph[i][0], "end": paragraph[j][1], "probability": chance, "share": share}
                for i, j, family, chance, share in sorted(found)
            ]

        yield from in_batches(rows(), schema, 1024)

    return run


def scan(docs: DataFrame, least: float = 0.5, max_unknown: int = MAX_UNKNOWN, model: LicenceModel | None = None) -> DataFrame:
    """Licence paragraphs of every document; one row per row of ``docs``.

    Columns: ``doc_id``, ``n_paragraphs``, ``families`` (sorted, distinct,
    comma-joined; empty if none) and ``found`` (family, code point span,
    calibrated probability against the unknown class, share of the template).
    ``n_paragraphs`` counts lines with text. Each line is tried alone, then
    neighbouring lines together, as far as no line without words lies between
    them, so that wrapped texts are found. A line or a run of lines can have
    several families; one below ``least`` or without a confirming template is
    not reported. The model is fitted once on a bounded sample; texts are read
    whole where they lie and nothing shuffles.

    A null text is an empty one, null ids pass through, repeated rows are
    scanned each, an empty table gives an empty result.
    """
    fitted = model or train(docs, max_unknown)
    texts = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    found = texts.mapInArrow(_scan(fitted, least), f"doc_id long, n_paragraphs long, found {FOUND}")
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda s: s["family"]))), ",")
    return found.select("doc_id", "n_paragraphs", families.alias("families"), "found")
