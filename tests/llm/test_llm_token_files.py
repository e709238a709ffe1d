import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm import token_files as T
from millrace.session import shared_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "Foo,bar. It's don't,", "<|endoftext|> x <|ENDOFTEXT|>, y.", "É, é. 3. a3, ..., '., \t x\x1cy", "İS ΣΑΣ.", "a\r\nb,\n\nc.", " ", "\n", " ́a", "a\x85b", "﻿x  \n y"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def expected(tokenizer, rows):
    """Rows in file order; of equal ids any order of the texts is allowed, as long as starts have no gaps."""
    return Counter((r[0], len(whole(tokenizer, r[1])), zlib.crc32(np.array(whole(tokenizer, r[1]), "<u4").tobytes())) for r in rows)


@pytest.mark.parametrize("remembered", [50, 1_000_000])
def test_many_texts_have_the_ids_of_each(corpus, tokenizer, monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    texts = [t or "" for t in corpus] + ODD
    encoder = T.Encoder(TOKENIZER)
    for some in (texts, texts[::-1], ODD, [""], ["", ""]):
        ids, ends = encoder.encode(some, 1)
        assert [p.tolist() for p in np.split(ids, ends[:-1])] == [whole(tokenizer, t) for t in some]


def test_round_trip(docs, rows, no_docs, tokenizer):
    out = T.round_trip(docs, TOKENIZER).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == expected(tokenizer, rows)
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert T.round_trip(no_docs, TOKENIZER).count() == 0


@pytest.mark.parametrize("segment", [1, 2000, 10**6])
def test_files(spark, docs, rows, tokenizer, monkeypatch, segment):
    monkeypatch.setattr(T, "SEGMENT", segment)
    folder = shared_dir(spark, "ids")
    T.write_ids(docs, TOKENIZER, folder)
    got = Counter((r.doc_id, tuple(r.ids)) for r in T.read_ids(spark, folder).collect())
    assert got == Counter((r[0], tuple(whole(tokenizer, r[1]))) for r in rows)
    sha, dictionary = T.read_dictionary(spark, folder)
    segments = spark.read.parquet(f"{folder}/segments")
    assert hashlib.sha256(dictionary).hexdigest() == sha
    assert {r[0] for r in segments.select("dictionary_sha256").collect()} == {sha}
    assert segments.where("size(offsets) <> size(ids) + 1 OR length(payload) <> element_at(offsets, -1)").count() == 0
    assert (segments.count() == len(rows)) if segment == 1 else segments.count() < len(rows)
    # one document at a time; id 3 has two texts, one id has a repeated row
    for i in (3, rows[5][0], rows[-4][0], None):
        want = sorted(whole(tokenizer, r[1]) for r in rows if r[0] == i)
        assert sorted(T.read_document(spark, folder, i)) == want
    assert T.read_document(spark, folder, -1) == []


def test_a_wrong_dictionary_is_an_error(spark, docs):
    folder = shared_dir(spark, "ids")
    T.write_ids(docs, TOKENIZER, folder)
    other = spark.createDataFrame([(hashlib.sha256(b"x").hexdigest(), bytearray(b"x"))], "sha256 string, bytes binary")
    other.write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        T.read_ids(spark, folder).collect()


def test_dictionary_serves_short_documents(spark):
    rng = np.random.default_rng(3)
    phrases = [" ".join("".join(rng.choice(list("aeioulnrst"), 5)) for _ in range(8)) for _ in range(40)]
    texts = [" ".join(rng.choice(phrases, 2)) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dictionary = T.trained_dictionary(df, TOKENIZER, 1)
    assert 256 <= len(dictionary) <= T.DICTIONARY_BYTES
    ids, ends = T.Encoder(TOKENIZER).encode(texts, 1)
    raw = [p.astype("<u2").tobytes() for p in np.split(ids, ends[:-1])]
    size = lambda d: sum(len(T._compressor(d).compress(r)) for r in raw)
    assert size(dictionary) < 0.6 * size(b"")


def test_string_ids_and_hot_ids(spark, tokenizer):
    rows = [("k", f"words of {i} here") for i in range(300)] + [("a", None), ("z", "The end."), (None, "none")]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("start", F.lit(1))
    out = T.round_trip(df, TOKENIZER).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == expected(tokenizer, rows)
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)
