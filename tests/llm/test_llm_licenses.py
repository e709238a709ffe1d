import pytest

from millrace.llm import licenses as L


@pytest.fixture(scope="module")
def classifier(corpus):
    return L.fit([p for t in corpus for p in (t or "").split("\n")][:2000])


def test_templates_and_variants_are_recognised(classifier):
    for family, templates in L.TEMPLATES.items():
        for t in templates:
            for text in (t, t.upper(), f"first line\n{t}\nlast line"):
                found = list(classifier.judge(text))
                assert [(f, ok) for _, f, _, _, ok in found] == [(family, True)], text
    assert [k for k, *_ in classifier.judge("first line\nReleased under the MIT License.\nlast")] == [1]


def test_other_senses_and_prose_are_unknown(classifier, corpus):
    for t in [*L.OTHER_SENSES, *(c or "" for c in corpus)]:
        assert not [x for x in classifier.judge(t) if x[-1]], t


def test_triggers_lose_no_report(classifier, corpus):
    every = L.Classifier(classifier.features, classifier.weights, classifier.temperature, classifier.least)
    every.triggers = [""]
    texts = [t or "" for t in corpus] + L.OTHER_SENSES + [x for ts in L.TEMPLATES.values() for x in ts]
    texts += [" ".join(x.split()[::2]) for ts in L.TEMPLATES.values() for x in ts]
    for t in texts:
        assert list(every.judge(t)) == list(classifier.judge(t))


def test_frames(spark, docs, no_docs):
    rows = [(1, "words\nLicensed under CC BY-NC 4.0."), (1, "words\nLicensed under CC BY-NC 4.0."), (2, None), (None, "This work is licensed under the GNU General Public License, version 3.")]
    out = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0, r.paragraph, r.family, r.confirmed) for r in out)) == [(0, 0, "gpl", True), (1, 1, "cc-by-nc", True), (1, 1, "cc-by-nc", True)]
    assert L.scan(docs).where("confirmed").count() == 0
    assert L.scan(no_docs).count() == 0


def test_other_licences_are_not_taken_for_their_neighbours(classifier):
    head = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by the Free Software Foundation"
    cases = {
        head.format("library", "Lesser"): "lgpl",
        head.format("program", "Affero"): "agpl",
        "Licensed under CC BY-ND 4.0.": "cc-by-nd",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa",
        "Made available under the terms of the Eclipse Public License v. 2.0": "epl",
        "Released under the ISC License.": "isc",
        "Licensed under the Business Source License 1.1.": "bsl",
    }
    for text, family in cases.items():
        assert [x[1] for x in classifier.judge(text) if x[-1]] == [family], text
    held = ["Licensed under the European Union Public Licence, version 1.2.", "Released under the Academic Free License 3.0.", "Licensed under the Open Software License 3.0.", "Released under the Microsoft Public License."]
    for text in held:
        assert not [x for x in classifier.judge(text) if x[-1]], text
