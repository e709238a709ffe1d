"""SentencePiece encoding by Viterbi over an Aho-Corasick automaton, and the decoding that undoes it.

The automaton holds all pieces of the vocabulary.  One pass over a text reports, at each end position, the pieces that
end there: the longest suffix that is a piece and, along its output links, all shorter ones.  Each relaxes the best
score of its end position from that of its start.  A character that no piece covers becomes the pieces of its bytes at
a penalty.  Best is the highest sum of scores; of equal sums the one whose last piece is longer, at each position.

A piece has blanks only at its front, so the best segmentation of a text is that of its blank-led words one after the
other; words that were seen before in the task are not encoded again.  Where a vocabulary has pieces with inner blanks
or line ends, whole texts are encoded at once.

Blanks are written as U+2581 and one is put in front, as in the vocabulary's own normalisation.  U+2581 itself is
written in bytes, so that decoding gives exactly the text that was encoded.

Defined cases: a null text is an empty one, with no pieces; repeated rows are repeated; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Words whose pieces a task remembers before it starts afresh.
REMEMBERED = 400_000
#: Subtracted from the lowest score of a piece for each byte of an uncovered character.
PENALTY = 10.0
#: Scores below mark pieces that the vocabulary keeps out of segmentations: runs of blanks.
UNUSED = -1e8
_WORD = re.compile(r"\n| *[^ \n]+| +")


class Vocabulary:
    def __init__(self, pieces: list[str], scores: list[float], bytes_from: int):
        """``bytes_from``: the id of the piece of byte 0; those of the others follow.  Empty strings are not matched."""
        self.pieces, self.scores, self.bytes_from = pieces, scores, bytes_from
        self.automaton = ahocorasick.Automaton()
        used = [(p, i) for i, p in enumerate(pieces) if p and not bytes_from <= i < bytes_from + 256]
        for p, i in used:
            self.automaton.add_word(p, (len(p), scores[i], i))
        self.automaton.make_automaton()
        self.low = min((scores[i] for _, i in used), default=0.0) - PENALTY
        self.by_word = not any("\n" in p or BLANK in p.lstrip(BLANK) for p, _ in used)
        self.known: dict[str, bytes] = {}
        #: What each id stands for.
        self.bytes = [p.replace(BLANK, " ").encode() for p in pieces]
        for b in range(256):
            self.bytes[bytes_from + b] = bytes([b])

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = lambda i: not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > UNUSED
        pieces = [model.id_to_piece(i) if plain(i) else "" for i in ids]
        return cls(pieces, [model.get_score(i) for i in ids], model.piece_to_id("<0x00>"))

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text whose blanks are U+2581."""
        n = len(text)
        score, back, piece = [0.0] + [-1e300] * n, [0] * (n + 1), [-1] * (n + 1)
        low, done = self.low, 0

        def uncovered(upto: int) -> None:
            # Positions before the next match: one character in bytes, from the best there is.
            nonlocal done
            while done < upto:
                done += 1
                char = text[done - 1]
                other = score[done - 1] + low * (1 if char == BLANK else len(char.encode()))
                if other > score[done]:
                    score[done], back[done], piece[done] = other, done - 1, -1

        for end, (size, gain, i) in self.automaton.iter(text):
            if end > done:
                uncovered(end)
            total = score[end + 1 - size] + gain
            # Matches at one end come longest first, so that equal sums keep the longer piece.
            if total > score[end + 1]:
                score[end + 1], back[end + 1], piece[end + 1] = total, end + 1 - size, i
        uncovered(n)
        out: list[int] = []
        while n:
            if piece[n] >= 0:
                out.append(piece[n])
            else:
                out.extend(self.bytes_from + b for b in reversed(text[back[n] : n].replace(BLANK, " ").encode()))
            n = back[n]
        return out[::-1]

    def word(self, text: str) -> bytes:
        ids: list[int] = []
        for k, part in enumerate(text.split(BLANK)):  # U+2581 of the text itself
            if k:
                ids.extend(self.bytes_from + b for b in BLANK.encode())
            ids.extend(self.best(part.replace(" ", BLANK)))
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if not self.by_word:
            return self.word(" " + text)
        words, known = _WORD.findall(" " + text), self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self.word(w)
            return b"".join(map(known.__getitem__, words))

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()
        return text[1:]


def encode(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.read(model)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                ids = [np.frombuffer(vocabulary.encode(t or ""), "<u4").astype(np.int32) for t in batch.column(1).slice(a, 512).to_pylist()]
                ends = np.cumsum([0] + [len(x) for x in ids])
                values = pa.array(np.concatenate(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, 512), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["doc_id", "ids"]
                )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text, from doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.read(model)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                rows = batch.slice(a, 512)
                texts = [vocabulary.decode(np.array(x or [], "<u4").tobytes()) for x in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digest(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes every text, decodes it again and compares: doc_id, n_pieces, n_byte_pieces, ids_crc32, decoded_crc32,
    round_trip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.read(model)
        first = vocabulary.bytes_from
        for batch in batches:
            rows = []
            for a in range(0, batch.num_rows, 512):
                for t in batch.column(1).slice(a, 512).to_pylist():
                    ids, t = vocabulary.encode(t or ""), t or ""
                    back, numbers = vocabulary.decode(ids), np.frombuffer(ids, "<u4")
                    spelled = int(((numbers >= first) & (numbers < first + 256)).sum())
                    rows.append((len(numbers), spelled, zlib.crc32(ids), zlib.crc32(back.encode()), back == t))
            columns = [list(c) for c in zip(*rows)] or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.bool_())],
                names=["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "decoded_crc32", "round_trip"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("doc_id"), text).mapInArrow(
        run, f"doc_id {kind}, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
    )
