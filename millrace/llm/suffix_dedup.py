"""Repeated strings of a fixed length, removed by prefix-free parsing.

1. Parsing.  A rolling hash over 16 bytes is a trigger where it is the smallest among the ``REACH`` places that a string
   of ``length`` bytes can begin its search with.  Triggers cut the texts into phrases.  Each string belongs to the first
   trigger it elects; that depends on the string's own bytes only, so equal strings are aligned at equal triggers.  A
   string is then a suffix of the phrase before its trigger followed by a prefix of the parse from the trigger on.
2. Dictionary and parse are compared by name first.  A trigger's ``core`` names the part of the parse that all its
   strings have in common, its ``full`` name everything that any of them covers.  A core that occurs once has no
   repeats.  A full name that occurs twice makes all its strings repeats.  This settles all but the ends of repeated
   passages, and needs no bytes to be moved.
3. What is left is one row for each distinct surrounding of a core, with the bytes left of the trigger and right of the
   core.  Rows of one core form a collection of their own: suffixes that share no core cannot share ``length`` bytes.
   In it, the suffix array of the dictionary (phrases before the trigger, read backwards) and the suffix array of the
   parse (what follows the core), each with the lengths that neighbours have in common, combine into the corpus order:
   for each number of bytes left of the trigger, rows in the same interval of both arrays begin the same string.
   Cores with more than ``CROWDED`` surroundings are split by the strings themselves and counted by their names.

Strings are judged on the input; a document's removed runs are the union of its repeated strings.

Defined cases: a null text is empty; texts shorter than ``length`` keep everything; rows that repeat a document repeat
its strings; documents with one id but different texts are told apart; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import text_key

LENGTH = 400
#: A trigger is elected among so many places; must leave a core: REACH + 127 <= length.
REACH = 256
CROWDED = 20_000
_BLOCK = 128
_GROUP = 1_000_000
_ROWS = 40_000
#: Rows of crowded cores whose strings are named together.
_NAMED_ROWS = 200


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _names(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 16 bytes and of the 128 bytes from each position on (meaningless near the end)."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    size, sixteen = 1, h
    while size < _BLOCK:
        h = h * np.uint64(0xD6E8FEB86659FD93 + 2 * size)
        h[:-size] += np.roll(h, -size)[:-size] >> np.uint64(7)
        h = _mix(h)
        size *= 2
        if size == 16:
            sixteen = h
    return sixteen, h


def _elected(names: np.ndarray, reach: int) -> np.ndarray:
    """For each position the last place of the smallest name among the next ``reach`` (a power of two)."""
    places = np.uint64(0xFFFFFFFF) - np.arange(len(names), dtype=np.uint64)
    best = (names >> np.uint64(32) << np.uint64(32)) | places
    size = 1
    while size < reach:
        best[:-size] = np.minimum(best[:-size], best[size:])
        size *= 2
    return (np.uint64(0xFFFFFFFF) - (best & np.uint64(0xFFFFFFFF))).astype(np.int64)


def parse(texts: list[bytes], length: int, reach: int) -> tuple[np.ndarray, ...]:
    """Triggers of many texts: text number, first string's position, ``lo`` and ``hi`` (bytes left of the trigger that
    the trigger's strings have), names of core and of everything covered."""
    nothing = np.zeros(0, np.int64)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    if not len(ends) or not any(len(t) >= length for t in texts):
        return (nothing,) * 6
    b = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.concatenate([[0], ends[:-1]])
    with np.errstate(over="ignore"):
        sixteen, block = _names(b)
        elected = _elected(sixteen, reach)
        edge = np.zeros(len(b) + 1, np.int8)
        fit = ends - begins >= length
        edge[begins[fit]] += 1
        edge[ends[fit] - length + 1] -= 1
        valid = np.cumsum(edge[:-1]) > 0
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (elected[1:] != elected[:-1])
        first = np.flatnonzero(new)
        last = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
        at = elected[first]
        doc = np.searchsorted(ends, first, side="right")
        core_size = length - reach + 1
        core = _mix(block[at] * np.uint64(3) + block[at + core_size - _BLOCK])
        size = last - first + length
        full = size.astype(np.uint64)
        for k in range(0, length + reach, _BLOCK):
            full = _mix(full * np.uint64(0x9FB21C651E98DF25) + block[first + np.minimum(k, size - _BLOCK)])
    return doc, first - begins[doc], at - last, at - first, core.view(np.int64), full.view(np.int64)


def _triggers(docs: DataFrame, length: int, reach: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            a = 0
            while a < len(texts):
                z, size = a, 0
                while z < len(texts) and (z == a or size + len(texts[z]) <= _GROUP):
                    size += len(texts[z])
                    z += 1
                doc, start, lo, hi, core, full = parse(texts[a:z], length, reach)
                rows = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows)]
                    + [pa.array(x, pa.int32()) for x in (start, lo, hi)]
                    + [pa.array(x, pa.int64()) for x in (core, full)],
                    names=["doc_id", "text_key", "start", "lo", "hi", "core", "full"],
                )
                a = z

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_key", "text").mapInArrow(
        run, f"doc_id {kind}, text_key long, start int, lo int, hi int, core long, full long"
    )


def _surroundings(rows: DataFrame, length: int, reach: int) -> DataFrame:
    """Adds ``left`` (bytes before the trigger) and ``right`` (bytes after the core) to each entry of ``rows``:
    doc_id, text_key, text, entries."""
    core_size = length - reach + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, entries = batch.column(2)[i].as_py().encode(), batch.column(3)[i].as_py()
                at = [e["start"] + e["hi"] for e in entries]
                columns = [pa.array([e[c] for e in entries], t) for c, t in (("start", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("core", pa.int64()), ("n", pa.int64()))]
                left = [text[p - e["hi"] : p] for p, e in zip(at, entries)]
                right = [text[p + core_size : p + length - e["lo"]] for p, e in zip(at, entries)]
                same = pa.array([0] * len(entries))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1).take(same), batch.column(1).slice(i, 1).take(same), *columns, pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    names=["doc_id", "text_key", "start", "lo", "hi", "core", "n", "left", "right"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, start int, lo int, hi int, core long, n long, left binary, right binary")


def _order(cores: list[int], strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A suffix array of ``strings`` within their cores and what each has in common with its predecessor; -1 where a
    core begins."""
    padded = [s.ljust(width, b"\0") for s in strings]
    order = np.array(sorted(range(len(padded)), key=lambda i: (cores[i], padded[i])), np.int64)
    table = np.frombuffer(b"".join(padded), np.uint8).reshape(len(padded), width)[order]
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    core = np.array(cores, np.int64)[order]
    common[core[1:] != core[:-1]] = -1
    return order, np.concatenate([[-1], common])


def repeated(cores: list[int], lo: np.ndarray, hi: np.ndarray, left: list[bytes], right: list[bytes], reach: int) -> np.ndarray:
    """For each row and number of bytes left of the trigger: does another row begin the same string?"""
    n = len(cores)
    out = np.zeros((n, reach), bool)
    width = reach - 1
    by_left, same_left = _order(cores, [x[::-1] for x in left], width)
    by_right, same_right = _order(cores, right, width)
    one, two = np.empty(n, np.int64), np.empty(n, np.int64)
    for k in range(reach):
        valid = np.flatnonzero((lo <= k) & (k <= hi))
        if len(valid) < 2:
            continue
        one[by_left] = np.cumsum(same_left < k)
        two[by_right] = np.cumsum(same_right < width - k)
        name = one[valid] * (n + 1) + two[valid]
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        out[valid[order[1:][same]], k] = True
        out[valid[order[:-1][same]], k] = True
    return out


def _ranges(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    step = np.diff(flags.astype(np.int8), prepend=0, append=0)
    yield from zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) - 1).tolist())


_SPAN = "start long, stop long"


def _by_suffix_arrays(rows: DataFrame, length: int, reach: int) -> DataFrame:
    """doc_id, text_key, start, stop of repeated strings, from surroundings sorted by core."""

    def solve(part: pa.Table) -> pa.RecordBatch:
        lo, hi = part.column("lo").to_numpy(), part.column("hi").to_numpy()
        flags = repeated(part.column("core").to_pylist(), lo, hi, part.column("left").to_pylist(), part.column("right").to_pylist(), reach)
        single = part.column("n").to_numpy() == 1
        start = part.column("start").to_numpy()
        at, begin, stop = [], [], []
        for i in np.flatnonzero(single & flags.any(axis=1)).tolist():
            for a, z in _ranges(flags[i]):
                at.append(i)
                begin.append(int(start[i] + hi[i] - z))
                stop.append(int(start[i] + hi[i] - a) + length)
        rows_ = pa.array(at, pa.int64())
        ids = part.select(["doc_id", "text_key"]).take(rows_).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [ids.column(0).combine_chunks(), ids.column(1).combine_chunks(), pa.array(begin, pa.int64()), pa.array(stop, pa.int64())],
            names=["doc_id", "text_key", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            core = batch.column("core").to_numpy()
            # Whole cores only: cut before the last one of the batch.
            cut = int(np.flatnonzero(core != core[-1])[-1]) + 1 if (core != core[-1]).any() else 0
            if held and size >= _ROWS and (cut or held[-1].column("core")[-1].as_py() != core[0]):
                head = batch.slice(0, cut)
                yield solve(pa.Table.from_batches([*held, head] if cut else held))
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, {_SPAN}")


def _by_names(rows: DataFrame, length: int, reach: int) -> DataFrame:
    """The same for crowded cores, one row per string: names are counted, so no group meets in one task."""

    width = reach - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # At most ``reach`` strings come of a row.
            for first in range(0, whole.num_rows, _NAMED_ROWS):
                batch = whole.slice(first, _NAMED_ROWS)
                lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
                around = [x + y for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())]
                begins = np.cumsum([0] + [len(x) for x in around])[:-1]
                # The string with k bytes left of the trigger is the window that begins hi - k bytes into the surroundings.
                number = hi - lo + 1
                at = np.repeat(np.arange(len(hi)), number)
                into = np.arange(len(at)) - np.repeat(np.cumsum(number) - number, number)
                with np.errstate(over="ignore"):
                    block = _names(np.frombuffer(b"".join(around), np.uint8))[1]
                    place, name = begins[at] + into, np.zeros(len(at), np.uint64)
                    for k in range(0, width, _BLOCK):
                        name = _mix(name * np.uint64(0x9FB21C651E98DF25) + block[place + min(k, width - _BLOCK)])
                rows_ = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(rows_) for c in ("doc_id", "text_key", "core", "n")]
                    + [pa.array((hi[at] - into).astype(np.int32)), pa.array(name.view(np.int64))]
                    + [pa.array(batch.column("start").to_numpy().astype(np.int64)[at] + into)],
                    names=["doc_id", "text_key", "core", "n", "k", "name", "start"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    strings = rows.mapInArrow(run, f"doc_id {kind}, text_key long, core long, n long, k int, name long, start long")
    strings = materialise(strings, label="strings")
    twice = strings.groupBy("core", "k", "name").agg(F.sum("n").alias("times")).where("times > 1").select("core", "k", "name")
    found = strings.where("n = 1").join(twice, ["core", "k", "name"])
    return found.select("doc_id", "text_key", "start", (F.col("start") + length).alias("stop"))


def _same_document(one: DataFrame, two: DataFrame) -> Column:
    return one["doc_id"].eqNullSafe(two["doc_id"]) & (one["text_key"] == two["text_key"])


def repeats(docs: DataFrame, length: int = LENGTH, reach: int = REACH, crowded: int = CROWDED) -> DataFrame:
    """doc_id, text_key, start, stop: ranges of repeated strings of documents (doc_id, text_key, text)."""
    triggers = materialise(_triggers(docs, length, reach), label="triggers")
    cores = triggers.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("full").alias("a"), F.max("full").alias("z"))
    # Written, so that the join reads two plain shuffles and Spark can split a core that copies share.
    cores = materialise(cores.where("n > 1").select("core", (F.col("a") < F.col("z")).alias("mixed")), label="cores")
    again = materialise(triggers.join(cores, "core"), label="again")
    key = ["doc_id", "text_key"]
    span = [*key, F.col("start").cast("long"), (F.col("start") + F.col("hi") - F.col("lo") + length).cast("long").alias("stop")]
    plain = again.where("NOT mixed").select(*span)
    mixed = again.where("mixed").drop("mixed")
    # Where a name occurs once its row is the one that stands for it; of others any will do.
    one = F.min(F.struct("doc_id", "text_key", "start", "lo", "hi")).alias("one")
    names = materialise(mixed.groupBy("core", "full").agg(F.count(F.lit(1)).alias("n"), one), label="names")
    twice = mixed.join(names.where("n > 1").select("core", "full"), ["core", "full"]).select(*span)
    # One row for each surrounding of a core; where all surroundings are settled already, none is needed.
    open_cores = names.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("least = 1")
    open_cores = materialise(open_cores, label="open")
    open_ = names.join(open_cores.select("core", "k"), "core").select("one.*", "core", "n", "k")
    entries = open_.groupBy(*key).agg(F.collect_list(F.struct("start", "lo", "hi", "core", "n", "k")).alias("entries"))
    near = docs.join(entries.hint("merge"), _same_document(docs, entries)).select(docs["doc_id"], docs["text_key"], "text", "entries")
    near = near.dropDuplicates(key) if _repeated_rows(docs) else near
    around = materialise(_surroundings(near, length, reach), label="surroundings")
    counts = open_cores.select("core", "k")
    many = around.join(counts.where(F.col("k") > crowded), "core", "left_semi")
    few = around.join(counts.where(F.col("k") > crowded), "core", "left_anti").repartition("core").sortWithinPartitions("core")
    edges = _by_suffix_arrays(few.select(*around.columns), length, reach)
    return plain.unionByName(twice).unionByName(edges).unionByName(_by_names(many.select(*around.columns), length, reach))


def _repeated_rows(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty()


def _span_lists(column: pa.ListArray) -> Iterator[list[tuple[int, int]]]:
    """The spans of one document after the other; never those of a whole batch as objects."""
    starts, stops = (column.values.field(k).to_numpy() for k in (0, 1))
    offsets, missing = column.offsets.to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
    for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        yield [] if missing[i] else list(zip(starts[a:z].tolist(), stops[a:z].tolist()))


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left, and how many runs were removed."""
    kept, runs, at = [], 0, 0
    stop = -1
    for a, z in sorted(spans):
        if a > stop:
            runs += 1
            kept.append(text[at:a])
        stop = max(stop, z)
        at = stop
    kept.append(text[at:])
    return b"".join(kept), runs


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    lists = spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return docs.join(lists.hint("merge"), _same_document(docs, lists), "left").drop(lists["doc_id"]).drop(lists["text_key"])


def dedup_report(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    plain = docs.select(F.col(id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    rows = _with_spans(plain, repeats(plain, length)).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(1), _span_lists(batch.column(2))):
                b = (t.as_py() or "").encode()
                kept, runs = _cut(b, spans)
                out.append((len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            columns = [list(c) for c in zip(*out)] or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = plain.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with what is left of their texts; bytes of characters that were cut apart go as well."""
    names = docs.columns
    place = names.index(text)
    # Working names throughout: the columns of the documents may have any.
    held = [f"c{i}" for i in range(len(names))]
    keyed = docs.toDF(*held).select(*held, F.col(f"c{names.index(id)}").alias("doc_id"), text_key(f"c{place}").alias("text_key"))
    spans = repeats(keyed.select("doc_id", "text_key", F.col(f"c{place}").alias("text")), length)
    rows = _with_spans(keyed, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, spans_ in zip(batch.column(place), _span_lists(batch.column(len(held)))):
                t = t.as_py()
                if t is not None and spans_:
                    t = _cut(t.encode(), spans_)[0].decode(errors="ignore")
                texts.append(t)
            columns = list(batch.columns[: len(held)])
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=held)

    return rows.select(*held, "spans").mapInArrow(run, docs.toDF(*held).schema).toDF(*names)
