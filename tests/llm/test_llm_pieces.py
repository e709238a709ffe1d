import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from millrace.llm import pieces as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def slow(v: P.Vocabulary, text: str) -> float:
    """The best score by trying every piece at every place."""
    size = max(map(len, v.pieces))
    known = {p: v.scores[i] for i, p in enumerate(v.pieces) if p and not v.bytes_from <= i < v.bytes_from + 256}
    text = (" " + text).replace(P.BLANK, "").replace(" ", P.BLANK)
    best = [0.0] + [-1e300] * len(text)
    for end in range(1, len(text) + 1):
        c = text[end - 1]
        cost = 0 if c == "" else 1 if c == P.BLANK else len(c.encode())
        best[end] = best[end - 1] + v.low * cost
        for start in range(max(0, end - size), end):
            if text[start:end] in known:
                best[end] = max(best[end], best[start] + known[text[start:end]])
    return best[-1]


def score(v: P.Vocabulary, ids) -> float:
    blank = [v.bytes_from + b for b in P.BLANK.encode()]
    out, ids = 0.0, list(ids)
    while ids:
        if ids[:3] == blank:  # U+2581 of the text costs nothing
            ids = ids[3:]
        elif v.bytes_from <= ids[0] < v.bytes_from + 256:
            out += v.low
            ids = ids[1:]
        else:
            out += v.scores[ids[0]]
            ids = ids[1:]
    return out


def test_segmentations_are_the_best(corpus):
    v = P.Vocabulary.read(MODEL)
    assert v.by_word
    for t in corpus:
        t = (t or "")[:300]
        ids = np.frombuffer(v.encode(t), "<u4")
        assert v.decode(ids.tobytes()) == t
        if t:
            assert abs(score(v, ids) - slow(v, t)) < 1e-6


def test_words_apart_are_words_together(corpus):
    v = P.Vocabulary.read(MODEL)
    for t in corpus[:20]:
        if t:
            assert v.encode(t) == v.word(" " + t)


def test_small_vocabulary_with_ties():
    pieces = ["a", "b", "ab", "aba", "▁", "ba"] + [f"<0x{i:02X}>" for i in range(256)]
    v = P.Vocabulary(pieces, [-1.0, -1.0, -2.0, -3.0, -1.0, -2.0] + [0.0] * 256, 6)
    assert np.frombuffer(v.encode("aba"), "<u4").tolist() == [4, 3]  # of equal sums the longer last piece
    assert v.decode(v.encode("a ba éab")) == "a ba éab"


def test_frames(docs, no_docs, rows):
    encoded = P.encode(docs, MODEL)
    back = Counter((r.doc_id, r.text) for r in P.decode(encoded, MODEL).collect())
    assert back == Counter((r[0], r[1] or "") for r in rows)
    found = {(r.doc_id, r.n_pieces, r.ids_crc32) for r in P.digest(docs, MODEL).collect()}
    assert found == {(r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in encoded.collect()}
    assert P.digest(docs, MODEL).where("NOT round_trip").count() == 0
    assert P.encode(no_docs, MODEL).count() == P.digest(no_docs, MODEL).count() == 0
