import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from millrace.llm import periodic as P


def brute(words):
    """All runs, by definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                part = words[i : i + size]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (None,) * 4
    if runs:
        s, size, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        top = (s, size, q, 1000 * size // q)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)), digest(kept))


@pytest.fixture(scope="module")
def wordy():
    rng = random.Random(4)
    out = []
    for i in range(260):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            p = rng.choice([1, 2, 3, 7])
            words = [words[j % min(p, len(words))] for j in range(rng.randint(0, 80))] if words else []
        out.append((i, rng.choice([" ", "\n", "\t ", "  "]).join(words)))
    return out


def test_runs_agree_with_brute_force():
    rng = random.Random(9)
    documents = []
    for _ in range(1500):
        n, k, p = rng.randint(0, 70), rng.randint(1, 3), rng.randint(1, 9)
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.7:
            words = [words[i % min(p, n)] if rng.random() < 0.96 else words[i] for i in range(n)]
        documents.append(words)
    got = P.find_runs(documents)
    assert got == [brute(d) for d in documents]
    assert sum(map(len, got)) > 500


@pytest.mark.parametrize("block", [2, 512])
def test_long_texts_in_blocks(monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    assert P.find_runs([[b"a"] * 5000]) == [[(0, 5000, 1)]]
    assert P.find_runs([[b"a", b"b"] * 3000 + [b"b"] * 7]) == [[(0, 6000, 2), (5999, 8, 1)]]
    fib = [b"a"], [b"a", b"b"]
    for _ in range(13):
        fib = fib[1], fib[1] + fib[0]
    words = fib[1] + fib[1] * 4
    assert P.find_runs([words]) == [brute(words)]


def test_common_prefixes_are_exact():
    import numpy as np

    rng = random.Random(2)
    words = np.array([rng.randrange(2) for _ in range(200)] + [2])
    one, other, length = P.common_prefixes(words, 1)
    suffix = lambda i: tuple(words[i:])
    order = sorted(range(len(words)), key=suffix)
    want = set()
    for a, z in zip(order, order[1:]):
        n = next((k for k, (x, y) in enumerate(zip(suffix(a), suffix(z))) if x != y), min(len(suffix(a)), len(suffix(z))))
        if n:
            want.add((a, z, n))
    assert set(zip(one.tolist(), other.tolist(), length.tolist())) == want


def test_documents(docs, rows, no_docs, spark, wordy):
    got = Counter(tuple(r) for r in P.digest(docs).collect())
    assert got == Counter(row(r[0], r[1]) for r in rows)
    df = spark.createDataFrame(wordy, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in P.digest(df).collect())
    assert got == Counter(row(*r) for r in wordy)
    assert sum(r[1] > 0 for r in got) > 40
    assert P.digest(no_docs).count() == 0


def test_chunks_change_nothing(spark, wordy, monkeypatch):
    df = spark.createDataFrame(wordy, "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, P.periodic_runs(df).collect()))
    monkeypatch.setattr(P, "WORDS", 50)
    assert sorted(map(tuple, P.periodic_runs(df).collect())) == want
    assert want == sorted((i, *r) for i, t in wordy for r in brute(t.split()))


def test_collapse_keeps_rows_and_columns(docs, rows, no_docs, spark):
    out = P.collapse(docs)
    assert out.columns == docs.columns
    want = []
    for r in rows:
        words = (r[1] or "").encode().split()
        runs = P.find_runs([words])[0]
        text = b" ".join(P.collapsed(words, runs)).decode() if runs else r[1]
        want.append((r[0], text, *r[2:]))
    assert Counter(tuple(r) for r in out.collect()) == Counter(want)
    assert any(w[1] != r[1] for w, r in zip(want, rows))
    assert P.collapse(no_docs).count() == 0 and P.periodic_runs(no_docs).count() == 0
    clash = spark.createDataFrame([("x " * 9, 1, 2)], "text string, start long, runs int")
    assert [tuple(r) for r in P.collapse(clash).collect()] == [("x", 1, 2)]
