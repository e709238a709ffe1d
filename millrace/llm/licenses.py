"""Licence notices by a trained paragraph classifier, confirmed against templates.

The classifier is a multinomial logistic regression over presence of word 1- and 2-grams, with a class "unknown".  Its
features are those of the templates and of other families' notices that count as unknown, so weights are few; an L1 penalty leaves most of them at zero.  It is trained on
templates with words left out, cut off or put among words of the corpus, against paragraphs of a bounded sample of the
documents (``SAMPLE_DOCUMENTS``, those of smallest hash) that resemble no template, against other families' notices and
against sentences that use the same words for other things.  A held-out fifth, with whole other families, calibrates it: a temperature by likelihood, then the least
probability at which at most ``FALSE_SHARE`` of the held-out unknown paragraphs would be reported.

Every paragraph (line) of every document is judged.  A paragraph can only reach the least probability if it has one of
the words that carry most weight, so texts without any of them are passed over; the bound that proves it is computed
from the weights.  A reported paragraph is confirmed when its words agree with a template of the predicted family and it has the words
that tell this template from similar ones of other families.

Defined cases: null and empty texts have no notices; repeated rows are reported again; an empty table gives an empty
result, whatever was learned from templates alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices of public licence families.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Licensed under the MIT license.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the Mozilla Public License 2.0.",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "cc0": [
        "Licensed under CC0 1.0.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0",
        "Released under the Eclipse Public License 2.0.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "Licensed under the ISC license.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
    "bsl": [
        "Use of this software is governed by the Business Source License 1.1",
        "Licensed under the Business Source License 1.1.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    ],
}
# Families that are not told apart, for the class "unknown".  Every third is for calibration only.
OTHER_FAMILIES = {
    "artistic": ["Released under the Artistic License 2.0.", "This program is free software; you can redistribute it under the terms of the Artistic License."],
    "cddl": ["The contents of this file are subject to the terms of the Common Development and Distribution License.", "Licensed under the CDDL 1.0."],
    "eupl": ["Licensed under the European Union Public Licence, version 1.2.", "Licensed under the EUPL."],
    "fdl": ["Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3"],
    "ms-pl": ["Released under the Microsoft Public License.", "This license governs use of the accompanying software. If you use the software, you accept this license."],
    "odbl": ["This database is made available under the Open Database License 1.0.", "Licensed under the ODbL."],
    "ofl": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "postgresql": ["Released under the PostgreSQL License.", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"],
    "sspl": ["This program is licensed under the Server Side Public License, version 1.", "Licensed under the SSPL."],
    "wtfpl": ["Released under the Do What The Fuck You Want To Public License.", "Licensed under the WTFPL."],
    "zlib": ["Released under the zlib License.", "This software is provided as-is, without any express or implied warranty."],
    "zpl": ["This software is subject to the provisions of the Zope Public License, Version 2.1."],
}
# The words of notices in other senses.
OTHER_SENSES = [
    "He renewed his driving license at the office in May.",
    "The license fee for the stadium was paid by the city.",
    "She was released from the hospital under the care of her sister.",
    "The general public was free to use the park without permission.",
    "Version 2.0 of the program was published by the foundation.",
    "A licensed plumber has to sign the form.",
    "Poetic license permits the author to modify the source of the story.",
    "This work was published in the journal of the foundation.",
    "The software was released in May and the documentation followed.",
    "Apache helicopters were seen under the clouds near the base.",
    "She studied at MIT before she joined the creative team.",
    "All conditions of the contract are met without modification.",
]
FAMILIES = ["unknown", *TEMPLATES]
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS = 400, 4_000
FALSE_SHARE = 0.001
CONFIRMED = 0.6
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)?")


def words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams(paragraph: str) -> set[str]:
    w = words(paragraph)
    return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}


def overlap(a: set[str], b: set[str]) -> float:
    """Common n-grams over those of the smaller."""
    return len(a & b) / max(1, min(len(a), len(b)))


def similarity(paragraph: set[str], family: str) -> float:
    """The best agreement with a template of the family."""
    return max(0.0, *(overlap(paragraph, grams(t)) for t in TEMPLATES[family]))


NEIGHBOURS = 0.5


def _telling() -> dict[str, list[tuple[set[str], set[str]]]]:
    """Of each template: per similar template of another family, the words that only the one and only the other has."""
    every = [(f, t, grams(t), set(words(t))) for f, ts in [*TEMPLATES.items(), *OTHER_FAMILIES.items()] for t in ts]
    return {
        t: [(w - w2, w2 - w) for f2, _, g2, w2 in every if f2 != f and overlap(g, g2) >= NEIGHBOURS]
        for f, t, g, w in every
        if f in TEMPLATES
    }


TELLING = _telling()


def confirmed(paragraph: set[str], family: str) -> bool:
    """Whether the paragraph agrees with a template of the family and, against every similar one of another family, has
    the words that tell them apart."""

    def better(own: set[str], other: set[str]) -> bool:
        mine = len(own & paragraph) / len(own) if own else 1.0
        theirs = len(other & paragraph) / len(other) if other else 0.0
        return mine >= 0.5 and mine > theirs

    agreeing = (t for t in TEMPLATES[family] if overlap(paragraph, grams(t)) >= CONFIRMED)
    return any(all(better(*x) for x in TELLING[t]) for t in agreeing)


class Classifier:
    """Weights, temperature and least probability of a report."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, temperature: float, least: float):
        self.features, self.weights, self.temperature, self.least = features, weights, temperature, least
        self.triggers = self._triggers()

    def row(self, found: set[str]) -> np.ndarray:
        x = np.zeros(len(self.features) + 1, np.float32)
        x[-1] = 1
        for g in found:
            i = self.features.get(g)
            if i is not None:
                x[i] = 1
        return x

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (x @ self.weights) / self.temperature
        z = np.exp(z - z.max(axis=-1, keepdims=True))
        return z / z.sum(axis=-1, keepdims=True)

    def _triggers(self) -> list[str]:
        """Words of which a paragraph needs at least one to be reported.

        A family's probability is at most that of its logit against "unknown" alone.  Without the features of these
        words the positive weights that are left cannot lift that logit to the least probability."""
        margin = self.weights[:, 1:] - self.weights[:, :1]
        need = (math.log(self.least) - math.log1p(-self.least)) * self.temperature
        by_word: dict[str, np.ndarray] = {}
        for g, i in self.features.items():
            # A 2-gram counts with its rarer-looking word, the longer one.
            w = max(g.split(" "), key=len)
            by_word[w] = by_word.get(w, 0) + np.maximum(margin[i], 0)
        left = margin[-1] + sum(by_word.values(), np.zeros(margin.shape[1]))
        out = []
        for w, gain in sorted(by_word.items(), key=lambda x: -x[1].max()):
            if (left < need).all():
                break
            out.append(w)
            left = left - gain
        return out

    def judge(self, text: str) -> Iterator[tuple[int, str, float, float, bool]]:
        """(paragraph, family, probability, similarity, confirmed) of the reported paragraphs."""
        low = text.lower()
        if not any(w in low for w in self.triggers):
            return
        for k, paragraph in enumerate(text.split("\n")):
            low = paragraph.lower()
            if any(w in low for w in self.triggers):
                found = grams(paragraph)
                p = self.probabilities(self.row(found))
                best = int(np.argmax(p))
                if best and p[best] >= self.least:
                    same = similarity(found, FAMILIES[best])
                    yield k, FAMILIES[best], round(float(p[best]), 6), round(same, 6), confirmed(found, FAMILIES[best])


def _train(x: np.ndarray, y: np.ndarray, classes: int, l1: float = 2e-4, steps: int = 400) -> np.ndarray:
    """Accelerated proximal gradient; the intercept, the last feature, is not penalised."""
    share = np.bincount(y, minlength=classes) / len(y)
    weight = (1 / (classes * np.maximum(share, 1e-9)))[y]
    target = np.eye(classes)[y]
    w = v = np.zeros((x.shape[1], classes))
    step, t = 4.0 / (0.5 * float(np.mean(weight * (x**2).sum(axis=1)))), 1.0
    for _ in range(steps):
        z = x @ v
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gradient = x.T @ ((p - target) * weight[:, None]) / len(y)
        new = v - step * gradient
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * l1, 0)
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / later * (new - w), new, later
    return w


def fit(paragraphs: list[str], seed: int = 6) -> Classifier:
    """Trains on templates against ``paragraphs`` of the corpus."""
    rng = np.random.default_rng(seed)
    plain = [p for p in paragraphs if words(p) and max(similarity(grams(p), f) for f in TEMPLATES) < 0.5]
    filler = [w for p in plain[:200] for w in p.split()] or ["text"]
    rows: list[tuple[str, int]] = [(p, 0) for p in plain] + [(p, 0) for p in OTHER_SENSES for _ in range(20)]
    def variants(t: str, label: int, telling: set[str], many: int) -> list[tuple[str, int]]:
        w, out = t.split(), [(t, label)] * (many // 5)
        for _ in range(many):
            kept = [x for x in w if rng.random() > rng.choice([0.0, 0.05, 0.15]) or telling & set(words(x))] or w
            extra = [filler[j] for j in rng.integers(0, len(filler), rng.integers(0, 12))]
            out.append((" ".join([*extra[: len(extra) // 2], *kept, *extra[len(extra) // 2 :]]), label))
        return out

    for i, family in enumerate(TEMPLATES, 1):
        for t in TEMPLATES[family]:
            rows += variants(t, i, set().union(*(own for own, _ in TELLING[t])), 100)
    for k, ts in enumerate(OTHER_FAMILIES.values()):
        if k % 3 != 2:
            rows += [x for t in ts for x in variants(t, 0, set(words(t)), 100)]
    seen = len(rows)
    rows += [x for k, ts in enumerate(OTHER_FAMILIES.values()) if k % 3 == 2 for t in ts for x in variants(t, 0, set(words(t)), 20)]
    learned = [*TEMPLATES.values(), *(ts for k, ts in enumerate(OTHER_FAMILIES.values()) if k % 3 != 2)]
    names = sorted({g for ts in learned for t in ts for g in grams(t)})
    features = {g: i for i, g in enumerate(names)}
    blank = Classifier(features, np.zeros((len(names) + 1, len(FAMILIES))), 1.0, 0.5)
    x = np.stack([blank.row(grams(p)) for p, _ in rows])
    y = np.array([c for _, c in rows])
    held = rng.random(len(rows)) < 0.2
    held[seen:] = True
    w = _train(x[~held].astype(np.float64), y[~held], len(FAMILIES))

    def loss(temperature: float) -> float:
        p = Classifier(features, w, temperature, 0.5).probabilities(x[held])
        return -float(np.mean(np.log(p[np.arange(len(p)), y[held]] + 1e-12)))

    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    p = Classifier(features, w, temperature, 0.5).probabilities(x[held])
    unknown = np.sort(p[y[held] == 0][:, 1:].max(axis=1))
    allowed = int(FALSE_SHARE * len(unknown))
    least = float(unknown[-1 - allowed]) + 1e-6 if len(unknown) else 0.5
    return Classifier(features, w, temperature, min(max(0.5, least), 0.99))


def sample_paragraphs(docs: DataFrame, text: str) -> list[str]:
    """At most ``SAMPLE_PARAGRAPHS`` lines of at most ``SAMPLE_DOCUMENTS`` documents."""
    some = docs.where(F.col(text).isNotNull()).select(text).orderBy(F.xxhash64(text)).limit(SAMPLE_DOCUMENTS)
    lines = some.select(F.explode(F.slice(F.split(text, "\n"), 1, 50)).alias("p")).where("p <> ''")
    return [r.p for r in lines.orderBy(F.xxhash64("p"), "p").limit(SAMPLE_PARAGRAPHS).collect()]


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, paragraph (int, from 0), family, probability, similarity, confirmed: the notices of all documents."""
    c = fit(sample_paragraphs(docs, text))
    shared = docs.sparkSession.sparkContext.broadcast((c.features, c.weights, c.temperature, c.least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(*shared.value)
        for batch in batches:
            at, found = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for row in classifier.judge(t or ""):
                    at.append(i)
                    found.append(row)
            columns = [list(c) for c in zip(*found)] or [[]] * 5
            types = [pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "paragraph", "family", "probability", "similarity", "confirmed"],
            )

    kind = docs.schema[id].dataType.simpleString()
    ddl = f"doc_id {kind}, paragraph int, family string, probability double, similarity double, confirmed boolean"
    return docs.select(F.col(id).alias("doc_id"), text).mapInArrow(run, ddl)
