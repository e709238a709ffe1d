import hashlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import suffix_dedup as S


def brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_report_agrees_with_brute_force(docs, rows):
    got = sorted(tuple(r[1:]) for r in S.dedup_report(docs).collect())
    assert got == sorted(brute([r[1] for r in rows], 400))
    assert sum(r[1] for r in got) > 3000


@pytest.mark.parametrize("crowded", [0, 2])
def test_crowded_cores_give_the_same_spans(docs, crowded):
    plain = docs.select("doc_id", S.text_key("text").alias("text_key"), "text")

    def covered(spans):
        out = set()
        for r in spans.collect():
            out.update((r.doc_id, r.text_key, p) for p in range(r.start, r.stop))
        return out

    assert covered(S.repeats(plain, crowded=crowded)) == covered(S.repeats(plain))


def test_suffix_arrays_find_what_naming_finds():
    rng = np.random.default_rng(1)
    n, reach = 60, 16
    cores = sorted(rng.integers(0, 5, n).tolist())
    hi = rng.integers(0, reach, n)
    lo = np.array([rng.integers(0, h + 1) for h in hi])
    left = [bytes(rng.integers(97, 99, h).astype(np.uint8)) for h in hi]
    right = [bytes(rng.integers(97, 99, reach - 1 - a).astype(np.uint8)) for a in lo]
    got = S.repeated(cores, lo, hi, left, right, reach)
    names = Counter((c, k, x[len(x) - k :], y[: reach - 1 - k]) for c, a, z, x, y in zip(cores, lo, hi, left, right) for k in range(a, z + 1))
    for i, (c, a, z, x, y) in enumerate(zip(cores, lo, hi, left, right)):
        for k in range(reach):
            assert got[i, k] == (a <= k <= z and names[c, k, x[len(x) - k :], y[: reach - 1 - k]] > 1)


def test_removal_keeps_columns_and_whole_characters(docs, no_docs):
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert S.remove_repeats(no_docs).count() == 0
    assert S.dedup_report(no_docs).count() == 0
