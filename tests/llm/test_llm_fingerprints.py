import hashlib
import random
from collections import Counter

from millrace.llm import fingerprints as P


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 70))) for _ in range(2))
        assert P.edit_distance(a, b) == levenshtein(a, b)


def test_fingerprint_does_not_depend_on_neighbours(corpus):
    texts = [(t or "").encode() for t in corpus]
    together = P.Fingerprints().of(texts)
    assert together == [P.Fingerprints().of([t])[0] for t in texts]
    for f in together:
        assert len(f.split(":")[1]) <= P.PIECES + 1


def test_edits_stay_near_and_strangers_far():
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghijkl", k=rng.randint(2, 9))) for _ in range(n)).encode()
    p = P.Fingerprints()
    for n in (60, 300, 3000):
        a, b = prose(n), prose(n)
        changed = a[: len(a) // 2] + b"inserted words" + a[len(a) // 2 :]
        one, two, other = p.of([a, changed, b])
        assert P.likeness(one, two) > 0.75 and P.likeness(one, one) == 1.0
        assert P.likeness(one, other) < 0.2
        assert P.likeness(one, two) == P.likeness(two, one)


def test_documents(docs, rows, no_docs):
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in P.fingerprint_documents(docs).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = Counter()
    p = P.Fingerprints()
    for r, t, f in zip(order, texts, texts[1:] + texts[:1]):
        third = len(t) // 3
        e = t[: len(t) - third] + f[:third]
        one, two, three = p.of([t.encode(), e.encode(), f.encode()])
        want[r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), one, two, P.likeness(one, two), P.likeness(one, three)] += 1
    assert got == want
    assert P.fingerprint_documents(no_docs).count() == 0


def test_one_document(spark):
    row = P.fingerprint_documents(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in row] == [(5, 1.0)]
    assert row[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_ids_of_any_type(spark, rows):
    texts = [r[1] or "" for r in rows][:20]
    df = spark.createDataFrame([(f"id{i:03}", t) for i, t in enumerate(texts)] + [(None, "last")], "doc_id string, text string")
    got = {r.doc_id: r.edited_sha256 for r in P.fingerprint_documents(df.repartition(4)).collect()}
    falling = [*reversed(texts), "last"]
    for i, t, f in zip([*(f"id{i:03}" for i in reversed(range(20))), None], falling, falling[1:] + falling[:1]):
        third = len(t) // 3
        assert got[i] == hashlib.sha256((t[: len(t) - third] + f[:third]).encode()).hexdigest()
