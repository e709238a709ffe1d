"""Runs: stretches of words that repeat with a period at least four times over, found and collapsed.

A run is a stretch with smallest period q, of at least 6 and at least 4 q words, that neither neighbour extends.

1. Suffixes.  The words of many documents are numbered and sorted as suffixes by prefix doubling; a position whose prefix
   is already its own is not sorted again.  The ranks of all rounds give what neighbours in suffix order have in
   common.  Only documents in which some five words come twice take part: no other has a run.
2. Descending order of common prefixes.  Neighbours in suffix order are edges weighted by their common prefix.  Edges are
   taken from the heaviest down; each unites two classes of suffixes, kept by union-find with the positions of a class
   in order, the smaller class put into the larger.  Two positions that become adjacent in a class have exactly the
   weight as their common prefix: where it is at least three times their distance q, and the words before them differ,
   the first begins a run of period q and of q plus the weight words.  A smaller period would have put a third
   position between the two before, so q is the smallest; each run is met once, as its first two periods.

A task holds the words of ``WORDS`` words of documents at a time, or of one longer document; texts are not shuffled.

Defined cases: a null text has no words, like an empty one or one of separators only; repeated rows and ids are judged
row by row; runs may overlap; ties of the greatest exponent go to the smaller start, then the smaller period; an empty
table gives an empty result; columns other than the id and the text are left out of reports and kept by ``collapse``.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least so many periods and words.
PERIODS = 4
LEAST = 6
#: Words of documents that are sorted together.
WORDS = 400_000
#: Positions of a block of an ordered set; a block of twice as many is split.
BLOCK = 512

Run = tuple[int, int, int]


def split_words(text: str | None) -> list[bytes]:
    """Words between blanks and the characters 9 to 13; ``bytes.split`` separates at just these."""
    return (text or "").encode().split()


class Positions:
    """An ordered set of positions in blocks, so that putting one in moves a bounded number of others."""

    __slots__ = ("blocks", "lows", "size")

    def __init__(self, position: int):
        self.blocks, self.lows, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def neighbours(self, position: int) -> tuple[int, int]:
        """The positions around one that is not in the set; -1 where there is none."""
        b = bisect_left(self.lows, position) - 1
        if b < 0:
            return -1, self.lows[0]
        block = self.blocks[b]
        i = bisect_left(block, position)
        if i < len(block):
            return block[i - 1], block[i]
        return block[-1], self.lows[b + 1] if b + 1 < len(self.lows) else -1

    def add(self, position: int) -> None:
        b = max(0, bisect_left(self.lows, position) - 1)
        block = self.blocks[b]
        insort(block, position)
        self.lows[b] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[b : b + 1] = [block[:BLOCK], block[BLOCK:]]
            self.lows.insert(b + 1, block[BLOCK])


def common_prefixes(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of suffixes, and their common prefix: (one, other, length), those of ``least`` or more.

    ``words`` are numbers from 0 on; documents end with numbers that occur once each.
    """
    n = len(words)
    # The rank of a position is the first place of its class in the order, so that it stays when its class is one position.
    order = np.argsort(words, kind="stable")
    fresh = np.concatenate([[True], words[order][1:] != words[order][:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[n] = -1
    ranks, size = [rank], 1
    while True:
        place = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))  # places of classes of two and more
        if not len(place):
            break
        at = order[place]
        own, beyond = rank[at], rank[np.minimum(at + size, n)]
        # Classes are consecutive places, so sorting by class and what follows sorts each of them in place.
        by = np.lexsort((beyond, own))
        at, own, beyond = at[by], own[by], beyond[by]
        order[place] = at
        cut = np.concatenate([[True], (own[1:] != own[:-1]) | (beyond[1:] != beyond[:-1])])
        fresh[place[cut]] = True
        rank = rank.copy()
        rank[at] = place[np.maximum.accumulate(np.where(cut, np.arange(len(cut)), 0))]
        ranks.append(rank)
        size *= 2
    # Neighbours have in common what equal ranks of the rounds, from the last to the first, add up to.
    one, other = order[:-1], order[1:]
    level = max(0, least.bit_length() - 1)
    near = np.flatnonzero(ranks[min(level, len(ranks) - 1)][one] == ranks[min(level, len(ranks) - 1)][other]) if level < len(ranks) else np.zeros(0, np.int64)
    one, other = one[near], other[near]
    a, z = one.copy(), other.copy()
    for k in range(len(ranks) - 1, -1, -1):
        same = ranks[k][np.minimum(a, n)] == ranks[k][np.minimum(z, n)]
        a[same] += 1 << k
        z[same] += 1 << k
    length = a - one
    keep = length >= least
    return one[keep], other[keep], length[keep]


def kruskal_runs(words: np.ndarray) -> list[Run]:
    """(start, length, period) of all runs, by start and period."""
    least = min(max((PERIODS - 1) * q, LEAST - q) for q in range(1, LEAST))
    one, other, length = common_prefixes(words, least)
    by = np.argsort(-length, kind="stable")
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent[root]) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for x in np.unique(np.concatenate([one, other])).tolist():
        parent[x] = x
    seeds: list[Run] = []
    for x, y, weight in zip(one[by].tolist(), other[by].tolist(), length[by].tolist()):
        x, y = find(x), find(y)
        large, small = classes.pop(x, None) or Positions(x), classes.pop(y, None) or Positions(y)
        if large.size < small.size:
            large, small, x, y = small, large, y, x
        farthest = weight // (PERIODS - 1)
        moved, last = list(small), -1
        for i, p in enumerate(moved):
            left, right = large.neighbours(p)
            if left > last and p - left <= farthest and left >= 0:
                seeds.append((left, weight, p - left))
            if right >= 0 and right - p <= farthest and (i + 1 == len(moved) or moved[i + 1] > right):
                seeds.append((p, weight, right - p))
            last = p
        for p in moved:
            large.add(p)
        parent[y] = x
        classes[x] = large
    found = [(p, weight + q, q) for p, weight, q in seeds if weight + q >= LEAST and (p == 0 or words[p - 1] != words[p + q - 1])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(documents: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document, starts counted from its first word."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(d) for d in documents], np.int64)
    out: list[list[Run]] = [[] for _ in documents]
    total = int(sizes.sum())
    if not total:
        return out
    ids = np.fromiter((number[w] for d in documents for w in d), np.int64, total)
    ends = np.cumsum(sizes)
    active = _repeating(ids, ends, sizes)
    if not active.any():
        return out
    chosen = np.flatnonzero(active)
    begins = ends - sizes
    # Each document is followed by a number of its own.
    parts = [p for k, i in enumerate(chosen.tolist()) for p in (ids[begins[i] : ends[i]], [len(number) + k])]
    starts = np.concatenate([[0], np.cumsum(sizes[chosen] + 1)])
    for start, length, period in kruskal_runs(np.concatenate(parts)):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[chosen[k]].append((int(start - starts[k]), length, period))
    return out


def _repeating(ids: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Documents in which some five consecutive words come twice; hashes that collide only add documents."""
    width = LEAST - 1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros(len(sizes), bool)
    if len(ids) < width:
        return out
    with np.errstate(over="ignore"):
        h = doc[: len(ids) - width + 1].astype(np.uint64)
        for k in range(width):
            h = (h ^ ids[k : len(ids) - width + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
    inside = np.flatnonzero(doc[: len(h)] == doc[width - 1 :])
    by = inside[np.argsort(h[inside], kind="stable")]
    same = (h[by][1:] == h[by][:-1]) & (doc[by][1:] == doc[by][:-1])
    out[doc[by[1:][same]]] = True
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that are in no run behind its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length by period, compared exactly; of equal ones the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _judged(batches: Iterator[pa.RecordBatch], words_of: Callable[[pa.RecordBatch, int], list[bytes]]):
    """(batch, first row, documents' words, their runs), ``WORDS`` words at a time."""
    for batch in batches:
        a, held, size = 0, [], 0
        for i in range(batch.num_rows):
            held.append(words_of(batch, i))
            size += len(held[-1])
            if size >= WORDS or i + 1 == batch.num_rows:
                yield batch, a, held, find_runs(held)
                a, held, size = i + 1, [], 0


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, period: one row per run; words are numbered from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, held, found in _judged(batches, lambda b, i: split_words(b.column(1)[i].as_py())):
            at = [a + i for i, runs in enumerate(found) for _ in runs]
            columns = list(zip(*[r for runs in found for r in runs])) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "start", "length", "period"]
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, start long, length long, period long")


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, with texts that have runs replaced by their kept words, joined by blanks; others stay as they are."""
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, held, found in _judged(batches, lambda b, i: split_words(b.column(place)[i].as_py())):
            rows = batch.slice(a, len(held))
            columns = list(rows.columns)
            texts = [b" ".join(collapsed(w, r)).decode() if r else None for w, r in zip(held, found)]
            old = columns[place].to_pylist()
            columns[place] = pa.array([o if t is None else t for o, t in zip(old, texts)], columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def planted(words: list[bytes], key: object) -> list[bytes]:
    """A tenth of the keys have their words repeat from some place on; null keys have not."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def digest(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs and collapsed words of each document with planted repetitions."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, held, found in _judged(batches, lambda b, i: planted(split_words(b.column(1)[i].as_py()), b.column(0)[i].as_py())):
            rows = []
            for words, runs in zip(held, found):
                best = strongest(runs)
                top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                listed = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
                whole = b" ".join(collapsed(words, runs))
                rows.append((len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(whole).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, len(held)), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]], names=names
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:6]) + ", runs_sha256 string, collapsed_sha256 string"
    )
