"""Context-triggered piecewise fingerprints, and how alike two of them are.

A rolling hash over seven bytes ends a piece wherever its ``level`` lowest bits are zero, so piece ends depend on nearby
bytes only and an edit changes the pieces it touches.  Each piece gives one of 64 characters.  A fingerprint holds the
signatures at two block sizes: the smallest power of two at which a text has at most 64 piece ends, and the next.
Fingerprints are compared where they share a block size: one minus the edit distance over the longer length, the better
of the two block sizes; without a common run of four characters, or without a common block size, they are not alike.

Documents are sorted by range partitions, so each meets its successor in the same task; only the first and last document
of each partition are matched afterwards.  One shuffle moves the texts.

Defined cases: a null text is an empty one and empty texts have the fingerprint ``0::``; equal ids are ordered by text;
null ids come last; the only document of a table is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

PIECES = 64
HIGHEST = 31
#: In texts of more bytes only ends of level 2 and up are looked at: at lower ones there are too many.
SHORT = 512
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
RUN = 4
_WINDOW = 7
_MULTIPLIER = 0x9E3779B97F4A7C15
_GROUP_CHARS = 1_000_000


def _rolling(b: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the seven bytes that end at each position; the first six positions mean nothing."""
    two = b.astype(np.uint32) * np.uint32(0x01000193)
    two[1:] += b[:-1]
    four = two * np.uint32(0x85EBCA6B)
    four[2:] += two[:-2]
    r = four * np.uint32(0xC2B2AE35)
    r[3:] += four[:-3]
    r ^= r >> np.uint32(15)
    r *= np.uint32(0x2C1B3C6D)
    r ^= r >> np.uint32(12)
    r *= np.uint32(0x297A2D39)
    r ^= r >> np.uint32(15)
    return r


class Fingerprints:
    def __init__(self) -> None:
        self._grow(1)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(n, _MULTIPLIER, np.uint64))
            self.inverse = np.cumprod(np.full(n, pow(_MULTIPLIER, -1, 1 << 64), np.uint64))

    def of(self, texts: list[bytes]) -> list[str]:
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        if n == 0:
            return ["0::"] * len(texts)
        if n > len(self.powers):
            self._grow(n)
        b = np.frombuffer(b"".join(texts), np.uint8)
        begins = ends - sizes
        r = _rolling(b)
        short = sizes <= SHORT
        at = np.flatnonzero(((r & np.uint32(3)) == 0) | np.repeat(short, sizes))
        doc = np.searchsorted(ends, at, side="right")
        inside = at - begins[doc] >= _WINDOW - 1
        at, doc = at[inside], doc[inside]
        low = r[at] & (~r[at] + np.uint32(1))
        zeros = np.where(low == 0, HIGHEST, np.log2(np.maximum(low, 1)).astype(np.int64))
        zeros = np.minimum(zeros, HIGHEST)
        # Piece ends of each document at each level, then the lowest level with few enough.
        count = np.bincount(doc * (HIGHEST + 2) + zeros, minlength=len(texts) * (HIGHEST + 2)).reshape(len(texts), HIGHEST + 2)
        reach = np.cumsum(count[:, ::-1], axis=1)[:, ::-1]
        reach[~short, :2] = PIECES + 1
        level = np.argmax(reach <= PIECES, axis=1)
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(b * self.powers[:n])])
        first, second = (self._signatures(total, at[zeros >= level[doc] + k], begins, ends, sizes) for k in (0, 1))
        return [f"{j}:{s}:{t}" for j, s, t in zip(level.tolist(), first, second)]

    def _signatures(self, total, at, begins, ends, sizes) -> list[str]:
        stops = np.unique(np.concatenate([at + 1, ends[sizes > 0]]))
        starts = np.concatenate([[0], stops[:-1]])
        with np.errstate(over="ignore"):
            pieces = (total[stops] - total[starts]) * self.inverse[starts]
            pieces = (pieces ^ (pieces >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        text = ALPHABET[(pieces >> np.uint64(58)).astype(np.int64)].tobytes().decode()
        upto = np.searchsorted(stops, ends, side="right").tolist()
        since = np.searchsorted(stops, begins, side="right").tolist()
        return [text[a:z] for a, z in zip(since, upto)]


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column at a time in the bits of one integer."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = full, 0
    for c in b:
        match = masks.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right, left = down | (full & ~(diagonal | up)), up & diagonal
        if right & top:
            score += 1
        if left & top:
            score -= 1
        right, left = (right << 1) | 1, left << 1
        up, down = full & (left | ~(diagonal | right)), full & right & diagonal
    return score


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(RUN, len(a), len(b))
    if run == 0 or not {a[i : i + run] for i in range(len(a) - run + 1)} & {b[i : i + run] for i in range(len(b) - run + 1)}:
        return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if one == other:
        return 1.0
    j, *a = one.split(":")
    k, *b = other.split(":")
    first = dict(zip((int(j), int(j) + 1), a))
    second = dict(zip((int(k), int(k) + 1), b))
    return max([0.0, *(_alike(first[x], second[x]) for x in first.keys() & second.keys() if first[x] and second[x])])


def edited(text: str, following: str) -> str:
    """The last third replaced by the beginning of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_DDL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(prints: Fingerprints, texts: list[str], after: str) -> list[list]:
    """Columns of ``_DDL`` for consecutive texts; ``after`` follows the last."""
    following = [*texts[1:], after]
    changed = [edited(t, f).encode() for t, f in zip(texts, following)]
    own = prints.of([t.encode() for t in following[-1:]] + [t.encode() for t in texts])
    mine, next_ = own[1:], [*own[2:], own[0]]
    theirs = prints.of(changed)
    return [
        [len(t) for t in texts],
        [hashlib.sha256(c).hexdigest() for c in changed],
        mine,
        theirs,
        [likeness(a, b) for a, b in zip(mine, theirs)],
        [likeness(a, b) for a, b in zip(mine, next_)],
    ]


def fingerprint_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    kind = docs.schema[id].dataType.simpleString()
    order = [F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")]
    ranged = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    ranged = ranged.repartitionByRange(F.desc_nulls_last("doc_id")).sortWithinPartitions(*order)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    names = [x.split()[0] for x in _DDL.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    kinds = [types[x.split()[1]] for x in _DDL.split(", ")]

    def result(keys, columns, at: str, texts: list[str | None], part: int) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [keys, *arrays, pa.array([at] * n, pa.string()), pa.array(texts, pa.string()), pa.array([part] * n, pa.int32())],
            names=["doc_id", *names, "at", "text", "part"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, nothing = Fingerprints(), [[None]] * len(names)
        held_keys, held, part = None, None, 0  # the last document so far, whose successor is not known yet
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            if held is None and texts:
                part = batch.column(2)[0].as_py()
                yield result(keys.slice(0, 1), nothing, "first", texts[:1], part)
            if held is not None:
                keys, texts = pa.concat_arrays([held_keys, keys]), [held, *texts]
            a = 0
            while a < len(texts) - 1:
                z, chars = a, 0
                while z < len(texts) - 1 and (z == a or chars + len(texts[z]) <= _GROUP_CHARS):
                    chars += len(texts[z])
                    z += 1
                yield result(keys.slice(a, z - a), _rows(prints, texts[a:z], texts[z]), "inside", [None] * (z - a), part)
                a = z
            if texts:
                held_keys, held = keys.slice(len(texts) - 1, 1), texts[-1]
        if held is not None:
            yield result(held_keys, nothing, "last", [held], part)

    found = materialise(ranged.mapInArrow(run, f"doc_id {kind}, {_DDL}, at string, text string, part int"), label="fingerprints")
    # Partitions hold ranges of ids in falling order, and as many first and last documents as there are of them.
    parts = sorted(r[0] for r in found.where("at = 'first'").select("part").collect())
    pairs = list(zip(parts, [*parts[1:], *parts[:1]]))
    pairs = docs.sparkSession.createDataFrame(pairs, "part int, following int")
    last = found.where("at = 'last'").select("part", "doc_id", F.col("text").alias("a"))
    first = found.where("at = 'first'").select(F.col("part").alias("following"), F.col("text").alias("b"))
    met = last.join(F.broadcast(pairs), "part").join(first, "following").select("doc_id", "a", "b")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints()
        for batch in batches:
            for i in range(batch.num_rows):
                columns = _rows(prints, [batch.column(1)[i].as_py()], batch.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=["doc_id", *names]
                )

    closed = met.mapInArrow(close, f"doc_id {kind}, {_DDL}")
    return found.where("at = 'inside'").select("doc_id", *names).unionByName(closed)
