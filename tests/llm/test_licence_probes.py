"""Licences that resemble each other, denied statements, short headers, and a plain version of the scan."""

import math
import re

import numpy as np
import pytest

from carelake.llm import licences
from carelake.llm.common import table

SF = "/root/testdata/sf0.001"
PROSE = ["Is and retitioning ouen the of, nterti thorreou ndernt.", "you may use the work and the text", "The terms of the work are free, and the public may read it."]


@pytest.fixture(scope="module")
def model():
    return licences.fit(PROSE)


@pytest.mark.parametrize(
    "line, families",
    [
        ("SPDX-License-Identifier: EPL-2.0", "epl"),
        ("Eclipse Public License 2.0", "epl"),
        ("GNU Affero General Public License", "agpl"),
        ("AGPL-3.0-only", "agpl"),
        ("GNU General Public License", "gpl"),
        ("GPL-2.0-or-later", "gpl"),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"),
        ("Licensed under CC BY-ND 4.0.", "cc-by-nd"),
        ("Licensed under CC BY-NC-ND 4.0.", "cc-by-nc-nd"),
        ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa"),
        ("Licensed under CC BY 4.0.", "cc-by"),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache,mit"),
        ("MIT License", "mit"),
        ("License: Apache-2.0", "apache"),
        ("Mozilla Public License Version 2.0", "mpl"),
        ("ISC License", "isc"),
        ("This file is not licensed under the MIT License.", ""),
        ("This is not released under the Apache License, Version 2.0.", ""),
        ("You need a license to drive in public.", ""),
        ("Ich gehe mit dir nach Hause.", ""),
        ("", ""),
    ],
)
def test_families_of_single_lines(model, line, families):
    assert ",".join(sorted(f for f, _, _ in model.labels(licences.word_ngrams(line), 0.5))) == families


def test_permission_and_warranty_texts_are_found_over_wrapped_lines(spark, model):
    isc = "Permission to use, copy, modify, and/or distribute this\nsoftware for any purpose with or without fee is hereby granted."
    mit = licences.TEMPLATES["mit"][-1].replace("KIND, ", "KIND,\n").replace("LIMITED TO ", "LIMITED TO\n")
    docs = spark.createDataFrame([(1, f"x\n\n{isc}\n\ny"), (2, f"a\n\n{mit}")], "doc_id long, text string")
    assert {r.doc_id: r.families for r in licences.scan(docs, model=model).collect()} == {1: "isc", 2: "mit"}


def test_calibration_is_set_on_templates_held_out(model):
    """A family's probability falls behind the share of right answers nowhere by much, and is below one."""
    assert model.temperature > 1.0
    chance = model.probabilities(licences.word_ngrams("Licensed under the MIT License."))
    assert chance.sum() == pytest.approx(1.0) and 0.5 < chance.max() < 0.9999


def plain_families(model, line):
    """The definition, word by word: the likeliest families first, each confirmed by a template not yet explained."""
    words = re.findall(r"[^\W_]+", line.lower())
    grams = set(words) | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
    score = [
        (b + sum(model.weights[g][k] for g in grams if g in model.weights)) / model.temperature for k, b in enumerate(model.bias)
    ]
    if not any(g in model.weights for g in grams):
        return set()
    odds = [math.exp(x - max(score)) for x in score]
    owners = {}
    for family, template in model.templates:
        for g in template:
            owners.setdefault(g, set()).add(family)
    found, explained = set(), set()
    for k in sorted(range(len(odds) - 1), key=lambda k: -odds[k]):
        if odds[k] <= odds[-1]:
            break
        fitting = []
        for family, template in model.templates:
            own = {g for g in template if owners[g] == {family}}
            if family == k and len(grams & own) >= 0.5 * len(own) and len(grams & template) >= 0.6 * len(template):
                fitting.append(template)
        new = [t - explained for t in fitting]
        if any(len(grams & t) >= max(0.6 * len(t), 1) for t in new):
            found.add(model.families[k])
            explained |= set().union(*fitting)
    return found


def test_scan_equals_the_plain_definition(spark):
    docs = table(spark, SF, "documents")
    model = licences.train(docs)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    some = 0
    for r in licences.scan(docs, model=model).collect():
        alone = {f for line in texts[r.doc_id].split("\n") for f in plain_families(model, line)}
        single = {s.family for s in r.found if "\n" not in texts[r.doc_id][s.start : s.end]}
        assert single == alone
        assert set(filter(None, r.families.split(","))) == {s.family for s in r.found}
        some += bool(alone)
    assert some > 0


def test_training_on_nothing(spark):
    model = licences.train(spark.createDataFrame([], "text string"))
    assert model.labels(licences.word_ngrams("Released under the MIT License."), 0.5)[0][0] == "mit"
    assert np.isfinite(model.probabilities(set())).all()
