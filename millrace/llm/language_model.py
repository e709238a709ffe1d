"""Quality by perplexity under interpolated modified Kneser-Ney models of trusted text: words over their spelling.

The word model is of order three, over words between blanks.  Counts come from all trusted documents.  They are sharded
by n-gram and stay in Spark; continuation counts, context totals and discounts are aggregates.  What a word has not been
seen after takes the context's remaining mass times the lower order, and the lowest order takes the word's spelling.
Spelling and blanks are scored by a model over bytes, of order three as well, whose at most 256 ** 3 entries go to the
tasks that score.

The word model grows with the corpus and reaches no task whole.  It is a bucketed table of shards; pairs of words decide
on the shard, so that what followed a pair, and what it followed, is counted in one place.  Documents are dealt to
blocks; a block asks for each of its distinct n-grams and contexts once, the questions go to the shards, where the counts
stay, and the answers return to the block.  N-grams are told apart by 64 bits.

Disk and memory: shards are counted in ``TURNS``, each over all trusted texts, and blocks are scored in ``ROUNDS``.
Counts, questions and answers are sorted columns, byte plane by byte plane and compressed.

Trusted documents would look better than others under a model that has counted them.  So texts are dealt to two halves
by their hash, each half has a word model, and every document is judged by that of the other half.

A document is kept when its perplexity per byte is at most the ``quantile`` of the trusted documents of its language,
times ``slack``.  Languages with fewer than ``least`` trusted documents share the quantile of all.

Defined cases: an empty or null text has no perplexity and is not kept; null languages are a language; repeated rows are
judged alike, repeated labels count once; without trusted documents nothing can be judged and all texts but empty ones
are kept, without perplexity; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_within
from ..session import discard, materialise, shared_dir
from .common import kept_rows, swept, text_key

SYMBOLS = 256
_GROUP = 1_000_000
#: Bytes of text in a block and of trusted text in a shard, and the least number of each.
BLOCK, LEAST_BLOCKS = 4 << 20, 96
SHARD, LEAST_SHARDS = 4 << 20, 48
#: Shards are counted and blocks scored in so many turns, at every size: that part of what is shuffled is on the disks at once.
TURNS, ROUNDS = 8, 10
#: Bytes of trusted text whose words are named together.
SLICE = 8 << 20
_START = 0x5BD1E995CA6D2C4A
#: Words of more bytes are hashed one by one.
_SHORT = 24
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def _keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 24 bits of each byte with its two predecessors, zeros before a text; and the texts' ends."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    b = np.frombuffer(b"".join(texts), np.uint8)
    keys = b.astype(np.int32)
    begins = np.concatenate([[0], ends[:-1]])[[len(t) > 0 for t in texts]] if len(texts) else np.zeros(0, np.int64)
    one = np.zeros(len(b), np.int32)
    one[1:] = b[:-1]
    one[begins] = 0
    two = np.zeros(len(b), np.int32)
    two[2:] = b[:-2]
    two[begins] = 0
    later = begins + 1
    later = later[later < len(b)]
    two[later] = 0
    keys += (one << 8) + (two << 16)
    return keys, ends


def _grouped(texts: list[str | bytes], most: int = _GROUP) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts) of about ``most`` bytes."""
    a = 0
    while a < len(texts):
        z, size, part = a, 0, []
        while z < len(texts) and (z == a or size + len(texts[z]) <= most):
            part.append(texts[z] if isinstance(texts[z], bytes) else texts[z].encode())
            size += len(texts[z])
            z += 1
        yield a, part
        a = z


def count_trigrams(texts: DataFrame) -> DataFrame:
    """key, n: over all texts of a one-column frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _grouped([t or "" for t in batch.column(0).to_pylist()]):
                keys, _ = _keys(part)
                seen, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(n, pa.int64())], names=["key", "n"])

    return texts.mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """For counts of one, two, and three or more."""
    return _discounts_of(*[x or 0 for x in counts.agg(*[F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4)]).first()])


def _discounts_of(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """From how many n-grams were counted once, twice, three and four times."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [i - (i + 1) * y * (b / a) if a else i / 2 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]


def _order(counts: DataFrame, lower: DataFrame, below: int) -> tuple[DataFrame, DataFrame]:
    """(key, p) and (context, rest) of one order.  ``lower`` has the probabilities of the order below, over ``below``
    keys; contexts are keys without their last byte."""
    one, two, more = _discounts(counts)
    context = F.shiftright("key", 8)
    off = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
    totals = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(off).alias("held"))
    totals = totals.select("context", "total", (F.col("held") / F.col("total")).alias("rest"))
    parts = counts.withColumn("context", context).withColumn("suffix", F.col("key").bitwiseAND(F.lit(below - 1)))
    joined = parts.join(totals, "context").join(lower.select(F.col("key").alias("suffix"), F.col("p").alias("q")), "suffix")
    p = (F.col("n") - off) / F.col("total") + F.col("rest") * F.col("q")
    return joined.select("key", p.alias("p")), totals.select("context", "rest")


#: Of one order: keys and probabilities of seen n-grams, contexts and what they leave to the unseen.
Order = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def fit(spark: SparkSession, texts: DataFrame) -> list[Order] | None:
    """The orders of a model of a one-column frame, lowest first; None without text."""
    three = materialise(count_trigrams(texts), label="trigrams")
    if three.isEmpty():
        return None
    suffix = lambda bits: F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("key")
    two = three.groupBy(suffix(16)).agg(F.count(F.lit(1)).alias("n"))
    one = two.groupBy(suffix(8)).agg(F.count(F.lit(1)).alias("n"))
    lower = spark.range(1).select(F.lit(0).alias("key"), F.lit(1.0 / SYMBOLS).alias("p"))
    orders = []
    for counts, below in ((one, 1), (two, 1 << 8), (three, 1 << 16)):
        p, rest = _order(counts, lower, below)
        lower = materialise(p, label="order")
        # At most 256 ** order rows.
        seen, left = lower.toPandas(), rest.toPandas()
        orders.append((seen["key"].to_numpy(), seen["p"].to_numpy(), left["context"].to_numpy(), left["rest"].to_numpy()))
    return orders


def log_table(orders: list[Order]) -> np.ndarray:
    """Logarithms of the probabilities of all 256 ** 3 trigrams."""
    q = np.full(1, 1.0 / SYMBOLS)
    for order, (key, p, context, rest) in enumerate(orders, 1):
        left = np.ones(SYMBOLS ** (order - 1), np.float32)
        left[context] = rest
        # A key is a context and a byte; the lower order's lacks the context's first byte.
        wide = np.empty(SYMBOLS**order, np.float32)
        np.multiply(left.reshape(-1, len(q) // SYMBOLS or 1, 1), q.reshape(1, -1, SYMBOLS if order > 1 else 1), out=wide.reshape(SYMBOLS if order > 1 else 1, -1, SYMBOLS))
        wide[key] = p
        q = wide
    return np.log(q, out=q)


def perplexities(docs: DataFrame, orders: list[Order], text: str) -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` and ``perplexity``."""
    keep = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(orders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = log_table(shared.value)
        for batch in batches:
            sizes, values = [], []
            for _, part in _grouped([t or "" for t in batch.column(len(keep)).to_pylist()]):
                keys, ends = _keys(part)
                total = np.concatenate([[0.0], np.cumsum(logs[keys], dtype=np.float64)])
                n = np.diff(ends, prepend=0)
                mean = np.diff(total[ends], prepend=0.0) / np.maximum(n, 1)
                sizes.extend(n.tolist())
                values.extend(np.where(n > 0, np.exp(-mean), np.nan).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(sizes, pa.int64()), pa.array(values, pa.float64(), from_pandas=True)],
                names=[*keep, "n_bytes", "perplexity"],
            )

    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text).mapInArrow(run, f"{ddl}, n_bytes long, perplexity double")


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _key(*words: np.ndarray) -> np.ndarray:
    """Of one to three words: hashes, rotated by their distance from the last."""
    key = words[-1]
    for i, w in enumerate(reversed(words[:-1]), 1):
        key = key ^ _rotated(w, 21 * i)
    return key


def _hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """64 bits of each: of short ones FNV-1a, mixed, a byte of all of them at a time."""
    _, offsets, data = words.buffers()
    begins = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    sizes, begins = np.diff(begins), begins[:-1]
    b = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    order = np.argsort(-sizes, kind="stable")
    long = int((sizes > _SHORT).sum())
    order, few = order[long:], order[:long]
    left, at = np.searchsorted(-sizes[order], -np.arange(_SHORT + 1)), begins[order]
    h = np.full(len(order), 0xCBF29CE484222325, np.uint64)
    for k in range(_SHORT):
        # The first ones have more than k bytes.
        n = left[k]
        h[:n] = (h[:n] ^ b[at[:n] + k]) * np.uint64(0x100000001B3)
    for by, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        h = (h ^ (h >> np.uint64(by))) * np.uint64(factor)
    out = np.empty(len(words), np.uint64)
    out[order] = h
    for i in few.tolist():
        out[i] = int.from_bytes(blake2b(b[begins[i] : begins[i] + sizes[i]], digest_size=8).digest(), "little")
    return out


#: Hashes of each word's second and first predecessor and of itself, with the model in the last bit; owner and bytes.
Words = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _words(texts: list[bytes], models: np.ndarray) -> Words:
    """(u, v, w, owner, begins, stops) of all words; positions as in the texts with a line feed between two."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = ~_BLANK[raw]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # The words without what is between them are the values of an array of bytes.
    offsets = np.concatenate([[0], np.cumsum(stops - begins)])
    names = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    owner = np.searchsorted(np.cumsum(sizes) - sizes, begins, side="right") - 1
    model = models.astype(np.uint64)[owner]
    w = (_hashes(names.dictionary)[names.indices.to_numpy()] & ~np.uint64(1)) | model
    start = np.uint64(_START) | model
    v, u = start.copy(), start.copy()
    v[1:] = np.where(owner[1:] == owner[:-1], w[:-1], v[1:])
    u[2:] = np.where(owner[2:] == owner[:-2], w[:-2], u[2:])
    return u, v, w, owner, begins, stops


def _folded(*columns: np.ndarray) -> bytes:
    """Columns of unsigned integers, byte plane by byte plane and compressed: of sorted hashes the first planes vanish."""
    head = np.array([len(columns), *[x for c in columns for x in (c.itemsize, len(c))]], np.int64)
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns)
    return head.tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unfolded(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    head = np.frombuffer(blob, np.int64, 2 * n, 8).reshape(n, 2).tolist()
    planes = np.frombuffer(pa.decompress(memoryview(blob)[8 + 16 * n :], sum(a * b for a, b in head), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for size, rows in head:
        out.append(np.ascontiguousarray(planes[at : at + size * rows].reshape(size, rows).T).reshape(-1).view(f"<u{size}"))
        at += size * rows
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where in a sorted array another value begins."""
    return np.flatnonzero(np.concatenate([[len(x) > 0], x[1:] != x[:-1]])[: len(x)])


def _shard(home: np.ndarray, shards: int) -> np.ndarray:
    return ((home >> np.uint64(1)) % np.uint64(shards)).astype(np.min_scalar_type(shards))


def _dealt(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of each shard, places in their order."""
    order = np.argsort(shard, kind="stable")
    first = _firsts(shard[order])
    for s, places in zip(shard[order][first].tolist(), np.split(order, first[1:])):
        yield s, places


def _contexts(context: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """context, sum of n, and how many n are one, two, and three or more."""
    order = np.argsort(context)
    context, n = context[order], n[order].astype(np.int64)
    first = _firsts(context)
    return [context[first], *(np.add.reduceat(x.astype(np.int64), first) if len(first) else n for x in (n, n == 1, n == 2, n > 2))]


def _side_by_side(seen: np.ndarray, n: np.ndarray, contexts: list[np.ndarray]) -> list[np.ndarray]:
    """key, n, and as a context total, one, two, more: what an n-gram is as such and what it is as a context."""
    keys = np.union1d(seen, contexts[0])
    out = [keys, *(np.zeros(len(keys), np.int64) for _ in range(5))]
    out[1][np.searchsorted(keys, seen)] = n
    at = np.searchsorted(keys, contexts[0])
    for to, x in zip(out[2:], contexts[1:]):
        to[at] = x
    return out


def _times(n: np.ndarray) -> list[int]:
    """How many are one, two, three and four."""
    return [int((n == i).sum()) for i in (1, 2, 3, 4)]


#: Rows of a model: kind is the order, 0 for words of one shard's pairs that are still to be added up.
MODEL = "shard int, shards int, tallies array<bigint>, entries binary, kind int"


def _rows(shards: int, found: list[tuple[int, int, list[int], list[np.ndarray]]]) -> pa.Table:
    """Of (kind, shard, tallies, columns)."""
    return pa.table(
        {
            "shard": pa.array([s for _, s, _, _ in found], pa.int32()),
            "shards": pa.array([shards] * len(found), pa.int32()),
            "tallies": pa.array([t + [0] * (12 - len(t)) for _, _, t, _ in found], pa.list_(pa.int64())),
            "entries": pa.array([_folded(*c[:1], *map(_narrow, c[1:])) for _, _, _, c in found], pa.binary()),
            "kind": pa.array([k for k, _, _, _ in found], pa.int32()),
        }
    )


def _tokens(texts: DataFrame) -> DataFrame:
    """size, tokens: slices of the texts of (text, model) as hashes of their words, starts included, and places among them."""

    def pack(texts: list[bytes], models: list[int]) -> bytes:
        _, v, w, owner, *_ = _words(texts, np.array(models))
        words, at = np.unique(np.concatenate([w, np.uint64(_START) | np.arange(2, dtype=np.uint64)]), return_inverse=True)
        head = np.diff(owner, prepend=-1) != 0
        return _folded(words, at[: len(w)].astype(np.uint32), np.packbits(head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, models, size = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            a = 0
            for _, part in _grouped(held, SLICE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sum(map(len, part))], pa.int64()), pa.array([pack(part, models[a : a + len(part)])], pa.binary())],
                    names=["size", "tokens"],
                )
                a += len(part)

        for batch in batches:
            more = [(t or "").encode() for t in batch.column(0).to_pylist()]
            held, models, size = held + more, models + batch.column(1).to_pylist(), size + sum(map(len, more))
            if size >= SLICE:
                yield from out()
                held, models, size = [], [], 0
        yield from out()

    return texts.mapInArrow(run, "size long, tokens binary")


def _count(tokens: DataFrame, shards: int, turn: int) -> DataFrame:
    """shard, side, triples: the word trigrams, each at the shard of its first two words (side 0) and at that of its last
    two (side 1), for the shards of this turn."""

    def triples(blob: bytes) -> Iterator[tuple[int, int, bytes]]:
        words, z, head = _unfolded(blob)
        head = np.unpackbits(head, count=len(z)).view(bool)
        # Of each word the start of its own model.
        start = np.searchsorted(words, np.uint64(_START) | (words & np.uint64(1))).astype(np.uint32)
        x, y = start[z], start[z]
        y[1:] = np.where(head[1:], y[1:], z[:-1])
        x[2:] = np.where(head[2:] | head[1:-1], x[2:], z[:-2])
        for side, home in ((0, (x, y)), (1, (y, z))):
            shard = _shard(_key(*(words[c] for c in home)), shards)
            mine = np.flatnonzero(shard % TURNS == turn)
            for s, places in _dealt(shard[mine]):
                at = mine[places]
                # Hashes in the order of the slice's, of the words that occur here.
                some = np.zeros(len(words), bool)
                for c in (x, y, z):
                    some[c[at]] = True
                renamed, few = np.cumsum(some) - 1, int(some.sum())
                a, b, c = (renamed[c[at]] for c in (x, y, z))
                pair = a * few + b
                order = np.lexsort((c, pair))
                a, b, c, pair = a[order], b[order], c[order], pair[order]
                first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (c[1:] != c[:-1])]))
                n = np.diff(first, append=len(order))
                yield s, side, _folded(words[some], *(_narrow(k) for k in (a[first], b[first], c[first], n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                if rows := list(triples(blob)):
                    s, side, blobs = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(side, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "side", "triples"])

    return tokens.select("tokens").mapInArrow(run, "shard int, side int, triples binary")


def fit_words(texts: DataFrame, name: str | None = None) -> DataFrame:
    """A bucketed table ``name`` in the shared folder: shard, shards, tallies, entries, kind.  ``texts``: text, model.

    Entries of kind 1 (words) and 2 (pairs) are key, n, and as a context total and how many followers have n of one, two
    and more; of kind 3 (trigrams) key and n.  n counts trigrams; of pairs and words it counts what precedes them.
    Tallies are the numbers of n of one to four; for words then the empty context's total, one, two, more by model.
    """
    spark = texts.sparkSession
    name, path = name or f"millrace_words_{uuid.uuid4().hex}", shared_dir(spark, "words")
    tokens = materialise(_tokens(texts), label="tokens")
    n = max(LEAST_SHARDS, -(-(tokens.agg(F.sum("size")).first()[0] or 0) // SHARD))

    def gathered(blobs: list[bytes]) -> list[np.ndarray]:
        """Distinct (key, u, v, w, n)."""
        parts = [_unfolded(x) for x in blobs]
        u, v, w = (np.concatenate([np.zeros(0, np.uint64), *[p[0][p[k]] for p in parts]]) for k in (1, 2, 3))
        times = np.concatenate([np.zeros(0, np.int64), *[p[4].astype(np.int64) for p in parts]])
        key = _key(u, v, w)
        order = np.argsort(key)
        first = _firsts(key[order])
        at = order[first]
        return [key[at], u[at], v[at], w[at], np.add.reduceat(times[order], first) if len(first) else times]

    def merge(table: pa.Table) -> pa.Table:
        sides, blobs = table.column("side").to_pylist(), table.column("triples").to_pylist()
        shard = table.column("shard")[0].as_py()
        key, u, v, _, times = gathered([b for b, s in zip(blobs, sides) if s == 0])
        found, contexts = [(3, shard, _times(times), [key, times])], _contexts(_key(u, v), times)
        _, _, v, w, _ = gathered([b for b, s in zip(blobs, sides) if s == 1])
        pair = _key(v, w)
        order = np.argsort(pair)
        first = _firsts(pair[order])
        at, before = order[first], np.diff(first, append=len(order))
        found.append((2, shard, _times(before), _side_by_side(pair[at], before, contexts)))
        seen, times = np.unique(w[at], return_counts=True)
        found.append((0, shard, [], _side_by_side(seen, times, _contexts(v[at], before))))
        return _rows(n, found)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                words = _unfolded(blob)
                own = [(s, _folded(*(c[places] for c in words))) for s, places in _dealt(_shard(words[0], n))]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in own], pa.int32()), pa.array([b for _, b in own], pa.binary())], names=["shard", "entries"])

    def add(table: pa.Table) -> pa.Table:
        parts = [_unfolded(x) for x in table.column("entries").to_pylist()]
        key, *rest = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(key)
        first = _firsts(key[order])
        key, rest = key[order][first], [np.add.reduceat(c[order].astype(np.int64), first) for c in rest]
        tallies = _times(rest[0])
        for model in (0, 1):
            x = rest[0][(key & np.uint64(1)) == model]
            tallies += [int(x.sum()), int((x == 1).sum()), int((x == 2).sum()), int((x > 2).sum())]
        return _rows(n, [(1, table.column("shard")[0].as_py(), tallies, [key, *rest])])

    def store(rows: DataFrame) -> None:
        # Bucketed by shard, so that no question moves the model.
        rows.write.mode("append").option("path", path).partitionBy("kind").bucketBy(buckets, "shard").saveAsTable(name)

    buckets = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = None
    for turn in range(TURNS):
        store(_count(tokens, n, turn).groupBy("shard").applyInArrow(merge, MODEL))
        # Words are added up every other turn: those of single shards are as large as the model.
        if turn % 2 or turn == TURNS - 1:
            parts = spark.table(name).where("kind = 0")
            more = parts if words is None else parts.unionByName(words)
            more = more.select("entries").mapInArrow(deal, "shard int, entries binary").groupBy("shard").applyInArrow(add, MODEL)
            more = materialise(more, label="words1")
            for old in (parts, words):
                if old is not None:
                    discard(old)
            words = more
    discard(tokens)
    store(words)
    discard(words)
    return spark.table(name).where("kind > 0")


def _asked(words: Words, models: np.ndarray, shards: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of words, pairs and trigrams: distinct keys, their shards, and at which key each word is as such, and its context is."""
    u, v, w, owner, *_ = words
    n, head = len(w), np.diff(owner, prepend=-1) != 0
    model = models.astype(np.int64)[owner]
    start = np.uint64(_START) | np.arange(2, dtype=np.uint64)
    out = []
    for seen, begin in ((w, start), (_key(v, w), _key(start, start))):
        keys, at = np.unique(np.concatenate([seen, begin]), return_inverse=True)
        # The context of a word's pair is the word before, that of its trigram the pair before.
        out.append((keys, _shard(keys, shards), at[:n], np.where(head, at[n + model], np.roll(at[:n], 1))))
    keys, at = np.unique(_key(u, v, w), return_inverse=True)
    shard = np.zeros(len(keys), out[1][1].dtype)
    shard[at] = out[1][1][out[1][3]]
    return [*out, (keys, shard, at, at)]


def fluency(docs: DataFrame, model: DataFrame, orders: list[Order], text: str, folds: Column) -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` and ``perplexity`` per byte, by words over spelling."""
    keep = [c for c in docs.columns if c != text]
    n = max(LEAST_BLOCKS, -(-(docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0) // BLOCK))
    sums = [F.sum(F.col("tallies")[i]).alias(f"t{i}") for i in range(12)]
    whole = {r["kind"]: r for r in model.groupBy("kind").agg(F.max("shards").alias("shards"), *sums).collect()}
    shards = max([r["shards"] for r in whole.values()], default=1)
    tallies = [[whole[k][f"t{i}"] for i in range(12)] if k in whole else [0] * 12 for k in (1, 2, 3)]
    steps = [np.array([0.0, *_discounts_of(*t[:4])]) for t in tallies]
    # Of the empty context, by model.
    first = [(t[0], steps[0][1:] @ np.array(t[1:])) for t in (tallies[0][4:8], tallies[0][8:])]
    names = [f"k{i}" for i in range(len(keep))]
    # Repeats of one row go to different blocks.
    dealt = docs.select(
        F.pmod(F.xxhash64(*keep, F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("block"),
        (F.lit(1) - folds).alias("model"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *[F.col(c).alias(k) for c, k in zip(keep, names)],
    )
    shared = docs.sparkSession.sparkContext.broadcast({"orders": orders})

    def texts_of(table: pa.Table) -> tuple[list[bytes], Words, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
        texts, models = [t.encode() for t in table.column("text").to_pylist()], table.column("model").to_numpy()
        words = _words(texts, models)
        return texts, words, _asked(words, models, shards)

    def ask(table: pa.Table) -> pa.Table:
        _, _, asked = texts_of(table)
        places = [dict(_dealt(shard)) for _, shard, _, _ in asked]
        to, none = sorted(set().union(*places)), np.zeros(0, np.int64)
        blobs = [_folded(*(keys[p.get(s, none)] for (keys, *_), p in zip(asked, places))) for s in to]
        block = table.column("block")[0].as_py()
        return pa.table({"shard": pa.array(to, pa.int32()), "block": pa.array([block] * len(to), pa.int32()), "keys": pa.array(blobs, pa.binary())})

    def answer(asked: pa.Table, counts: pa.Table) -> pa.Table:
        known = {k: _unfolded(x) for k, x in zip(counts.column("kind").to_pylist(), counts.column("entries").to_pylist())}
        blobs = []
        for blob in asked.column("keys").to_pylist():
            found = []
            for kind, keys in enumerate(_unfolded(blob), 1):
                own, *values = known.get(kind) or [np.zeros(0, np.uint64)] * (2 if kind == 3 else 6)
                at = np.minimum(np.searchsorted(own, keys), max(len(own) - 1, 0))
                hit = own[at] == keys if len(own) else np.zeros(len(keys), bool)
                found += [np.packbits(hit), *(_narrow(c[at[hit]]) for c in values)]
            blobs.append(_folded(*found))
        return pa.table({"block": asked.column("block"), "shard": asked.column("shard"), "found": pa.array(blobs, pa.binary())})

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        if "logs" not in shared.value:
            shared.value["logs"] = log_table(shared.value["orders"])
        logs = shared.value["logs"]
        texts, (_, _, w, owner, begins, stops), asked = texts_of(table)
        values = [[np.zeros(len(keys)) for _ in range(3 if k < 2 else 1)] for k, (keys, *_) in enumerate(asked)]
        places = [dict(_dealt(shard)) for _, shard, _, _ in asked]
        for s, blob in zip(answers.column("shard").to_pylist(), answers.column("found").to_pylist()):
            found = iter(_unfolded(blob))
            for k, (p, to) in enumerate(zip(places, values)):
                at = p.get(s, np.zeros(0, np.int64))
                at = at[np.unpackbits(next(found), count=len(at)).view(bool)]
                n = next(found)
                to[0][at] = n - steps[k][np.minimum(n, 3)]
                if k < 2:
                    total, *times = (next(found) for _ in range(4))
                    to[1][at] = total
                    to[2][at] = sum(d * c for d, c in zip(steps[k + 1][1:], times))
        spelling, total = np.empty(len(w)), np.empty(len(texts))
        lengths = np.array([len(t) for t in texts], np.int64)
        for a, part in _grouped(texts):
            keys, ends = _keys(part)
            spelled = np.concatenate([[0.0], np.cumsum(logs[keys], dtype=np.float64)])
            total[a : a + len(part)] = np.diff(spelled[ends], prepend=0.0)
            # Positions of words count a line feed per text before; spelling does not.
            x, y = np.searchsorted(owner, [a, a + len(part)])
            before = owner[x:y] + lengths[:a].sum()
            spelling[x:y] = spelled[stops[x:y] - before] - spelled[begins[x:y] - before]
        p, model = np.exp(spelling), (w & np.uint64(1)).astype(np.int64)
        contexts = [np.array(first)[model].T, *([x[asked[k][3]] for x in values[k][1:]] for k in (0, 1))]
        for (whole, held), (seen, *_), (_, _, at, _) in zip(contexts, values, asked):
            some = whole > 0
            over = np.where(some, whole, 1)
            p = np.where(some, seen[at] / over + held / over * p, p)
        # A word too long for its spelling to be a number has not been seen either.
        better = np.where(p > 0, np.log(np.maximum(p, 1e-300)), spelling)
        total = total + np.bincount(owner, better - spelling, minlength=len(texts))
        value = np.where(lengths > 0, np.exp(-total / np.maximum(lengths, 1)), np.nan)
        got = {k: table.column(k) for k in names}
        return pa.table(got | {"n_bytes": pa.array(lengths, pa.int64()), "perplexity": pa.array(value, pa.float64(), from_pandas=True)})

    ddl = ", ".join(f"{k} {docs.schema[c].dataType.simpleString()}" for c, k in zip(keep, names))
    scored = None
    for turn in range(ROUNDS):
        # Both sides read the same columns, so that the texts are dealt once.
        now = dealt.where(F.col("block") % ROUNDS == turn).groupBy("block")
        asked = now.applyInArrow(ask, "shard int, block int, keys binary")
        counts = model.select("shard", "kind", "entries").groupBy("shard")
        found = asked.groupBy("shard").cogroup(counts).applyInArrow(answer, "block int, shard int, found binary")
        part = now.cogroup(found.groupBy("block")).applyInArrow(score, f"{ddl}, n_bytes long, perplexity double")
        part = materialise(part, label="perplexities")
        scored = part if scored is None else scored.unionByName(part)
    return scored.select(*[F.col(k).alias(c) for c, k in zip(keep, names)], "n_bytes", "perplexity")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = 0.995,
    slack: float = 1.25,
    least: int = 100,
) -> DataFrame:
    """doc_id, text_key, n_bytes, perplexity, threshold, kept: one row per document.  Trusted are the documents that
    ``labels`` call good and not toxic."""
    spark = docs.sparkSession
    trusted = labels.where("quality = 1 AND toxic = 0").select(F.col(id).alias("doc_id")).distinct()
    narrow = docs.select(
        F.col(id).alias("doc_id"),
        text_key(text).alias("text_key"),
        F.coalesce(F.col(lang).cast("string"), F.lit("\x00")).alias("lang"),
        F.col(text).alias("text"),
    )
    # The ids of trusted documents grow with the corpus: never broadcast, the same join at every size.
    good = narrow.join(trusted.hint("merge"), "doc_id", "left_semi")
    orders = fit(spark, good.select("text"))
    if orders is None:
        empty = F.coalesce(F.octet_length("text"), F.lit(0))
        return narrow.select(
            "doc_id", "text_key", empty.cast("long").alias("n_bytes"), F.lit(None).cast("double").alias("perplexity"),
            F.lit(None).cast("double").alias("threshold"), (empty > 0).alias("kept"),
        )
    fold = F.pmod("text_key", F.lit(2))
    with swept(spark):
        name = f"millrace_words_{uuid.uuid4().hex}"
        model = fit_words(good.select("text", fold.alias("model")), name)
        scores = fluency(narrow, model, orders, "text", fold)
        discard(model)
        spark.sql(f"DROP TABLE {name}")
    known = scores.where(F.col("perplexity").isNotNull()).join(trusted, "doc_id", "left_semi")
    cut = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("cut")
    own = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), cut).where(F.col("n") >= least)
    own = materialise(own.select("lang", "cut"), label="thresholds")
    pooled = F.lit(known.agg(cut).first()["cut"])
    scores = scores.join(broadcast_within(own), "lang", "left")
    scores = scores.withColumn("threshold", F.coalesce("cut", pooled) * F.lit(slack))
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
    return scores.select("doc_id", "text_key", "n_bytes", "perplexity", "threshold", kept.alias("kept"))


def keep_fluent(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    verdicts = judge(docs, labels, **options).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    return kept_rows(docs, verdicts, options.get("id", "doc_id"), options.get("text", "text"))
