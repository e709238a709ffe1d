import zlib
from collections import Counter, defaultdict

import numpy as np

from millrace.llm import sharding as S


def check(out, shards):
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    sizes = [len(slots[i]) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_documents(docs, rows, no_docs):
    out = S.shard_documents(docs).collect()
    check(out, 24)
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}
    assert S.shard_documents(no_docs).count() == 0


def test_many_buckets_and_hot_keys(spark):
    rows = spark.createDataFrame([(1 if i % 3 else i, None if i % 5 else "x") for i in range(3000)], "shard long, slot string")
    renamed = rows.withColumnsRenamed({"shard": "a", "slot": "b"})
    out = S.shuffle_into_shards(renamed, 7, part_rows=100)
    check(out.collect(), 7)
    assert out.count() == 3000
    assert sorted(map(str, out.select("a", "b").collect())) == sorted(map(str, renamed.collect()))


def test_matrix_keeps_sums():
    sizes, room = [100, 0, 37, 500], [200, 137, 300]
    m = np.array(S.communication_matrix(sizes, room, 3))
    assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).tolist() == room


def test_draws_follow_the_hypergeometric_distribution():
    rng = np.random.default_rng(1)
    for good, bad, draws in ((5, 10, 6), (50, 1000, 200), (3_000_000_000, 9_000_000_000, 4_000_000)):
        got = np.array([S.hypergeometric(rng, good, bad, draws) for _ in range(4000)])
        total = good + bad
        mean = draws * good / total
        var = mean * (bad / total) * (total - draws) / (total - 1)
        assert abs(got.mean() - mean) < 5 * (var / 4000) ** 0.5
        assert 0.85 < got.var() / var < 1.15
    assert S.hypergeometric(rng, 0, 5, 3) == 0 and S.hypergeometric(rng, 5, 0, 3) == 3


def test_uniform(spark):
    """Each row is equally likely in each shard, and neighbours do not stay together."""
    rows = spark.createDataFrame([(i,) for i in range(4000)], "i long")
    out = S.shuffle_into_shards(rows, 4, part_rows=500).collect()
    low = Counter(r.shard for r in out if r.i < 1000)
    assert all(180 < low[s] < 320 for s in range(4))
    first = [r.i for r in out if r.slot < 500]
    assert 1800 < np.mean(first) < 2200
