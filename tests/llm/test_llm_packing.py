import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing as P

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def check(out, length):
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


def test_words_give_the_ids_of_whole_texts(corpus):
    t = Tokenizer.from_file(TOKENIZER)
    odd = ["Foo,bar. It's don't,", "<|endoftext|> x <|ENDOFTEXT|>, y.", "É, é. 3. a3, ..., '., \t x\x1cy", "İS ΣΑΣ.", "a\r\nb,\n\nc.", "it's. it'S, I'll."]
    texts = [x or "" for x in corpus] + odd
    got = P.WordIds(TOKENIZER).encode(texts)
    for text, ids in zip(texts, got):
        assert t.encode(text, add_special_tokens=False).ids == np.frombuffer(ids, "<u4").tolist()


def test_forgetting_changes_nothing(corpus, monkeypatch):
    texts = [x or "" for x in corpus]
    want = P.WordIds(TOKENIZER).encode(texts)
    monkeypatch.setattr(P, "REMEMBERED", 50)
    w = P.WordIds(TOKENIZER)
    assert [w.encode([t])[0] for t in texts] == want


def test_documents(docs, rows, no_docs):
    t = Tokenizer.from_file(TOKENIZER)
    out = P.pack_documents(docs, TOKENIZER, length=128).collect()
    want = Counter()
    for r in rows:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 128)):
            part = np.array(ids[a : a + 128], "<u4")
            want[r[0], k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = check(out, 128)
    assert bins <= -(-sum(r.length for r in out) // 128) + 2
    assert P.pack_documents(no_docs, TOKENIZER).count() == 0


def test_best_fit_decreasing_and_bound():
    rng = np.random.default_rng(5)
    for high in (30, 60, 100):
        sizes = rng.integers(1, high + 1, 400)
        where, offsets = P.best_fit_decreasing(sizes, 100)
        fill = np.bincount(where, weights=sizes)
        assert fill.max() <= 100
        # best fit by definition
        rooms = []
        for s in sorted(sizes.tolist(), reverse=True):
            fit = [i for i, r in enumerate(rooms) if r >= s]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= s
            else:
                rooms.append(100 - s)
        assert len(fill) == len(rooms)
        assert sizes.sum() / 100 <= P.lower_bound(sizes, 100) <= len(fill)
    assert P.lower_bound(np.array([60, 60, 60]), 100) == 3
    assert P.lower_bound(np.array([], np.int64), 100) == 0


def test_groups_exchange_what_is_open(spark):
    rng = np.random.default_rng(8)
    sizes = rng.integers(1, 101, 3000).tolist()
    rows = spark.createDataFrame(list(enumerate(sizes)), "row long, length long")
    out = P.pack(rows, 100, group_rows=100, rounds=6).join(rows, "row").withColumnRenamed("sequence", "sequence_id").collect()
    assert len(out) == 3000
    many = check(out, 100)
    where, _ = P.best_fit_decreasing(np.array(sizes), 100)
    assert many <= (where.max() + 1) * 1.02 + 2


def test_certificates(spark, docs):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 60, 4000).tolist()
    rows = spark.createDataFrame(list(enumerate(sizes)), "row long, length long").repartition(3)
    found = P.certified(rows, 100, group_rows=300)
    assert check(found.placed.join(rows, "row").withColumnRenamed("sequence", "sequence_id").collect(), 100) == found.sequences
    assert found.bound == P.lower_bound(np.array(sizes), 100)
    where, _ = P.best_fit_decreasing(np.array(sizes), 100)
    assert found.bound <= found.sequences <= 1.005 * (where.max() + 1) + 1
    groups = found.groups.collect()
    assert {r.turn for r in groups} > {0} and all(r.closed <= r.sequences and r.bound <= r.sequences for r in groups)
    last = max(r.turn for r in groups)
    assert sum(r.sequences if r.turn == last else r.closed for r in groups) == found.sequences
    out = P.pack_documents(docs, TOKENIZER, length=128).collect()
    assert {(r.n_sequences, True) for r in out} == {(len({r.sequence_id for r in out}), out[0].lower_bound <= out[0].n_sequences)}


def test_dealing_is_even_by_size(spark):
    rows = spark.createDataFrame([(i, 90 if i % 3 else 10) for i in range(3000)], "row long, length long").coalesce(1)
    out = rows.mapInPandas(P._deal(10, 0), "row long, length long, grp long").collect()
    for size, n in ((90, 200), (10, 100)):
        assert all(abs(c - n) <= 1 for c in Counter(r.grp for r in out if r.length == size).values())
