"""Best-fit packing whose sequence counts are certified by lower bounds.

Documents become token counts, only longer ones are cut.  Pieces are dealt to groups of bounded size, each batch by
falling size, so that all groups have large and small pieces alike.  Each group runs best-fit decreasing.  Lower bounds
come from dual feasible functions: for each threshold ``t`` the sizes above ``L - t`` count as whole sequences, those below
``t`` as nothing and the rest by their share.  The bound of the whole table needs only its histogram of at most ``L``
lengths, and certifies the total; each group's own bound is handed out beside it.  While the total is above the bound, the
emptier half of each group's sequences, but no full one, is dealt anew to fewer groups and packed again, until the total
meets the bound, a round gains nothing or one group is left.

The packer works on sizes of 1 to ``L``; which piece has which size matters to nobody, so a round moves rows of three
numbers, never text or ids.

Defined cases: a null text is an empty one, of one token, the closing id; repeated rows and ids are packed row by row;
ties go to the first row by number; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
import types
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Pieces of a group; of what a round releases, groups of this size are formed again.
GROUP_ROWS = 20_000
#: Distinct words whose ids a worker remembers before it starts afresh.
REMEMBERED = 1_600_000
_CHUNK = 2_000


class WordIds:
    """Ids of whole texts from remembered ids of words between blanks.

    The tokenizer never joins what blanks separate, so a text's ids are those of its words one after the other, and it
    lowers case itself, so ASCII capitals can be lowered before.  A comma or full stop behind a letter or digit at the
    end of a word is a token of its own.  New words are encoded many at a time, as one text, and told apart by the
    offsets of their tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # One memory for all tasks that the worker process runs: functions are shipped anew with each task.
        memory = sys.modules.setdefault("_millrace_words", types.ModuleType("_millrace_words"))
        self.known: dict[str, bytes] = memory.__dict__.setdefault(path, {})
        self.known[""] = b""

    def learn(self, words: Iterable[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.known[""] = b""
        ended = [w for w in words if len(w) > 1 and w[-1] in ".," and w[-2].isalnum() and w[-2].isascii()]
        bare = {w[:-1] for w in ended} | {".", ","}
        self._encode([w for w in bare.union(words).difference(ended) if w not in self.known])
        self.known.update((w, self.known[w[:-1]] + self.known[w[-1]]) for w in ended)

    def _encode(self, words: list[str]) -> None:
        for i in range(0, len(words), _CHUNK):
            part = words[i : i + _CHUNK]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in part])
            flat = np.array(found.ids, "<u4").tobytes()
            at = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            cuts = (np.searchsorted(at, starts) * 4).tolist()
            self.known.update(zip(part, [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids."""
        # The strings of special tokens have their ids in small letters only.
        texts = [t if "<|" in t else t.encode().lower().decode() for t in texts]
        split = [t.replace("\n", " ").split(" ") for t in texts]
        missing = {w for words in split for w in words}.difference(self.known)
        if missing:
            self.learn(missing)
        try:
            return [b"".join(map(self.known.__getitem__, words)) for words in split]
        except KeyError:  # the memory was cleared
            self.learn({w for words in split for w in words})
            return [b"".join(map(self.known.__getitem__, words)) for words in split]


def pieces_of(docs: DataFrame, tokenizer: str, length: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, step = WordIds(tokenizer), 4 * length
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            rows, where = [], []
            for a in range(0, len(texts), 256):
                for i, ids in enumerate(words.encode([t or "" for t in texts.slice(a, 256).to_pylist()]), a):
                    ids += b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
                        where.append(i)
            columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(where, pa.int64())), pa.array(columns[0], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[1:]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each size; sequences are numbered as they are opened."""
    order = np.argsort(-sizes, kind="stable")
    where, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    rooms: list[list[int]] = [[] for _ in range(length + 1)]  # sequences by the room that is left
    used, opened = 0, 0  # bit r of used: some sequence has room r
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = used >> size
        if fits:
            room = size + ((fits & -fits).bit_length() - 1)
            sequence = rooms[room].pop()
            if not rooms[room]:
                used ^= 1 << room
        else:
            room, sequence, opened = length, opened, opened + 1
        where[i], offsets[i] = sequence, length - room
        if room > size:
            rooms[room - size].append(sequence)
            used |= 1 << (room - size)
    return where, offsets


def lower_bound(sizes: np.ndarray, length: int) -> int:
    """The best bound of the dual feasible functions over all thresholds up to half a sequence."""
    return histogram_bound(np.bincount(sizes, minlength=length + 1), length)


def histogram_bound(count: np.ndarray, length: int) -> int:
    """The same from the number of pieces of each size from 0 to ``length``."""
    amount = np.cumsum(count * np.arange(length + 1))
    number = np.cumsum(count)
    t = np.arange(0, length // 2 + 1)
    large = number[-1] - number[length - t]
    middle = amount[length - t] - np.where(t > 0, amount[t - 1], 0)
    return int(np.max(large + -(-middle // length)))


def _deal(groups: int, turn: int):
    """A group for each piece: every stretch of as many pieces of falling size as there are groups goes to all of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            rng = np.random.default_rng((turn, int(pdf["row"].iat[0])))
            n = len(pdf)
            # The last stretch is a random choice of the groups, like all others in random order.
            grp = np.concatenate([rng.permutation(groups) for _ in range(n // groups)] + [rng.choice(groups, n % groups, replace=False)])
            out = np.empty(n, np.int64)
            out[np.argsort(-pdf["length"].to_numpy(), kind="stable")] = grp
            yield pd.DataFrame({"row": pdf["row"], "length": pdf["length"], "grp": out})

    return run


def _pack(length: int, base: int, room: int):
    """Sequences of group g are numbered from ``base + g * room``; ``begins`` says which row is the first of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in _groups(batches, held):
            sizes = pdf["length"].to_numpy()
            where, offsets = best_fit_decreasing(sizes, length)
            fill = np.bincount(where, weights=sizes).astype(np.int64)
            open_ = np.zeros(len(fill), bool)
            open_[np.argsort(fill, kind="stable")[: -(-len(fill) // 2)]] = True
            open_ &= fill < length
            yield pd.DataFrame(
                {
                    "grp": pdf["grp"],
                    "row": pdf["row"],
                    "length": sizes,
                    "sequence": base + pdf["grp"] * room + where,
                    "offset": offsets,
                    "open": open_[where],
                    "bound": lower_bound(sizes, length),
                }
            )

    return run


def _groups(batches: Iterator[pd.DataFrame], held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole groups of a partition that is sorted by group."""
    for pdf in batches:
        while len(pdf):
            same = pdf["grp"].to_numpy() == pdf["grp"].iat[0]
            end = len(pdf) if same.all() else int(np.argmin(same))
            if held and held[0]["grp"].iat[0] != pdf["grp"].iat[0]:
                yield pd.concat(held, ignore_index=True)
                held.clear()
            held.append(pdf.iloc[:end])
            pdf = pdf.iloc[end:]
    if held:
        yield pd.concat(held, ignore_index=True)


@dataclass(frozen=True)
class Packing:
    """``placed``: row, sequence, offset.  ``groups``: turn, grp, sequences, closed, bound of each group of each round.
    ``sequences`` are all there are, ``bound`` what any packing of the rows needs at least."""

    placed: DataFrame
    groups: DataFrame
    sequences: int
    bound: int


def pack(rows: DataFrame, length: int, group_rows: int = GROUP_ROWS, rounds: int | None = None) -> DataFrame:
    """row, sequence, offset for ``rows`` of (row, length): row numbers are distinct, lengths from 1 to ``length``."""
    return certified(rows, length, group_rows, rounds).placed


def certified(rows: DataFrame, length: int, group_rows: int = GROUP_ROWS, rounds: int | None = None) -> Packing:
    """The packing with its certificate; ``rounds`` ends it early where a caller wants that."""
    todo = rows.select("row", F.col("length").cast("long"))
    sizes = todo.groupBy("length").count().collect()
    count = np.zeros(length + 1, np.int64)
    count[[r[0] for r in sizes]] = [r[1] for r in sizes]
    bound, n = histogram_bound(count, length), int(count.sum())
    placed: list[DataFrame] = []
    reports: list[DataFrame] = []
    base, closed, before, turn = 0, 0, None, 0
    while True:
        groups = max(1, math.ceil(n / group_rows))
        # A group opens as many sequences as it has rows at most; dealing is even but for the last stretch of each batch.
        room = n
        dealt = todo.mapInPandas(_deal(groups, turn), "row long, length long, grp long")
        dealt = dealt.repartition(groups, "grp").sortWithinPartitions("grp", "row")
        packed = dealt.mapInPandas(
            _pack(length, base, room), "grp long, row long, length long, sequence long, offset long, open boolean, bound long"
        )
        packed = materialise(packed, label="packed")
        first = F.col("offset") == 0
        report = packed.groupBy(F.lit(turn).alias("turn"), "grp").agg(
            F.count_if(first).alias("sequences"), F.count_if(first & ~F.col("open")).alias("closed"), F.max("bound").alias("bound")
        )
        reports.append(report)
        opened, shut, left = report.agg(F.sum("sequences"), F.sum("closed")).first()[:2] + (packed.where("open").count(),)
        total = closed + (opened or 0)
        base, turn = base + groups * room, turn + 1
        if groups == 1 or left == 0 or total <= bound or (before is not None and total >= before) or turn == rounds:
            placed.append(packed)
            break
        placed.append(packed.where(~F.col("open")))
        todo = packed.where("open").select("row", "length")
        closed, before, n = closed + shut, total, left
    return Packing(reduce(DataFrame.unionByName, placed).select("row", "sequence", "offset"), reduce(DataFrame.unionByName, reports), total, bound)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    id: str = "doc_id",
    text: str = "text",
    group_rows: int = GROUP_ROWS,
    rounds: int | None = None,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece, and of the table the number of sequences
    and the lower bound that certifies it."""
    pieces = pieces_of(docs, tokenizer, length, id, text).withColumn("row", F.monotonically_increasing_id())
    pieces = materialise(pieces, label="pieces")
    whole = pieces.where(F.col("length") == length)
    part = pieces.where(F.col("length") < length)
    result = certified(part, length, group_rows, rounds)
    full = whole.count()
    # A full piece is a sequence of its own; numbers below zero are not given to others.
    alone = whole.select("*", (-1 - F.col("row")).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    both = part.join(result.placed, "row").select(*alone.columns).unionByName(alone)
    return both.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.col("sequence").alias("sequence_id"),
        "offset",
        F.lit(result.sequences + full).cast("long").alias("n_sequences"),
        F.lit(result.bound + full).cast("long").alias("lower_bound"),
    )
