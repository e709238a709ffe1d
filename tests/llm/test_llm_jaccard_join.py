import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import graph
from millrace.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(sets, percent):
    """Component by union-find over all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def expected(rows, like):
    sets = [shingles(t, like.words) for _, t in rows]
    roots = brute(sets, like.percent)
    lowest = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            lowest[r] = min(lowest.get(r, i), i)
    return Counter((i, len(s), lowest.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots))


@pytest.mark.parametrize("like", [J.Likeness(), J.Likeness(4, 85), J.Likeness(1, 50)])
def test_components_agree_with_brute_force(docs, rows, like):
    out = J.link(docs, like).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == expected([r[:2] for r in rows], like)


@pytest.mark.parametrize("sample", [1, 50])
def test_chains_clusters_and_common_passages(spark, monkeypatch, sample):
    """Chains that link only neighbours, clusters within a hair of the bound, one passage in all documents."""
    monkeypatch.setattr(J, "SAMPLE", sample)
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(0, 10**9)}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(4):
        text = [word() for _ in range(100)]
        for _ in range(12):
            rows.append((len(rows), " ".join(text)))
            at = int(rng.integers(0, 90))
            text = [*text[:at], word(), *text[at + 1 :]]
            if rng.random() < 0.6:
                text[int(rng.integers(0, 100))] = word()
    for _ in range(40):
        rows.append((len(rows), " ".join(passage + [word() for _ in range(int(rng.integers(5, 40)))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    like = J.Likeness()
    out = J.link(docs, like).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == expected(rows, like)


def test_one_of_each_group_stays(docs, rows, no_docs):
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    want = {(i, c) for i, n, c in expected([r[:2] for r in rows], J.Likeness())}
    assert {i for i in ids if i is not None} == {i for i, c in want if i is not None and i == c}
    assert J.keep_one(no_docs).count() == J.link(no_docs).count() == 0


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert [tuple(r) for r in J.keep_one(docs).collect()] == [(1, "a b c d e f")]


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    by = defaultdict(set)
    for r in found:
        by[r.component].add(r.node)
    assert sorted(map(len, by.values())) == [200, 201]
    assert all(c in nodes for c, nodes in by.items())
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_those_of_the_definition(corpus):
    s = J.Shingles(4)
    one = s.of([t or "" for t in corpus])
    assert [len(x) for x in one] == [len(shingles(t, 4)) for t in corpus]
    for t, x in zip(corpus, one):
        assert (s.of([t or ""])[0] == x).all()


def test_members_of_groups_meet_though_their_representatives_do_not(spark, monkeypatch):
    """Sets of one size and prefix whose other tokens differ: every member has to be tried, not only the first."""
    monkeypatch.setattr(J, "frequent_tokens", lambda *_: np.zeros(0, np.uint64))
    words = [f"w{i}" for i in range(400)]
    order = sorted(words, key=lambda w: int(J.Shingles(1).of([w])[0][0]))
    rng = np.random.default_rng(9)
    rows = []
    for size in (20, 21, 22):
        head = order[:12]
        for _ in range(8):
            rows.append((len(rows), " ".join(head + list(rng.choice(order[200:215], size - 12, replace=False)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (70, 80, 85):
        like = J.Likeness(1, percent)
        out = J.link(docs, like).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == expected(rows, like)


def test_first_meetings_lose_no_pair(spark):
    """Every pair that may link by sizes and by its first common token is met; late entries alone make no pairs."""
    r = random.Random(12)
    rows = []
    for g in range(150):
        n = r.choice([1, 2, 3, 5, 8, 20, 21, 22, 23, 24, 40, 100, 147, 147, 147, 173])
        p = n - -(-85 * n // 100) + 1
        for token in r.sample(range(12), min(12, p)):
            rows.append((token, g, n * (1 << 31) + r.randrange(p), g, g))
    df = spark.createDataFrame(rows, "token long, grp long, place long, lo long, hi long")
    for percent in (80, 85, 100):
        want = set()
        for t, g, x, *_ in rows:
            for u, h, y, *_ in rows:
                (n, i), (m, j) = divmod(x, 1 << 31), divmod(y, 1 << 31)
                if t == u and g < h and 100 * min(n, m) >= percent * max(n, m) and (100 + percent) * min(n - i, m - j) >= percent * (n + m):
                    want.add((g, h))
        assert {tuple(x) for x in J._first_meetings(df, percent).collect()} == want and want
    joined = df.withColumns({"lo": F.lit(1), "hi": F.lit(1)})
    assert J._first_meetings(joined, 85).count() == 0
