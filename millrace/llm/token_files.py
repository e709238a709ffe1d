"""Token ids in files, each document compressed on its own with a dictionary that all of them share.

Format.  A dataset is two tables in one folder.  ``dictionary`` has one row: the dictionary's bytes and their SHA-256.
``segments`` has rows of consecutive documents, some ``SEGMENT`` bytes each: the number of the file part and of the
segment in it, the first and last document id, the dictionary's SHA-256, the width of an id in bytes, the ids of the part
before the segment, and per document its id, its number of ids and the offset index (one more entry than documents) into
``payload``, the documents' frames one after the other.  A frame is a Zstandard frame of the little-endian ids.  To read
one document take the segment whose range of document ids has it, which the statistics of the files tell without reading
them, and decompress the bytes between two offsets.  Files are written by Spark, so a task that runs again replaces what
it wrote, and every store that Spark reaches will do.

The dictionary is trained on the serialized ids of ``SAMPLE`` distinct texts of at most ``SAMPLE_BYTES`` bytes, those with
the lowest hashes; only keys are ranked, never texts.  It is what makes frames of short documents small.

Ids are those of whole texts.  The tokenizer never joins what blanks separate, so the words of many texts are numbered
first and only the distinct ones are looked up or encoded.

Defined cases: a null text is an empty one and has the end id only; repeated rows and ids are documents of their own; null
ids come first; equal ids are in the order of their texts' hashes; with too few samples to train on the
dictionary is empty and frames stand alone; an empty table gives an empty dataset.  An id beyond the width, a dictionary
of another hash or a frame of another length is an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, shared_dir
from .common import text_key
from .packing import WordIds

#: Texts that the dictionary is trained on, their largest size, and the dictionary's.
SAMPLE = 2_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: Bytes of a segment; a longer document has one of its own.
SEGMENT = 1_000_000
#: Bytes of text that are encoded together.
CHUNK = 8_000_000


class Encoder:
    """Ids of many texts at once: words are numbered by Arrow, distinct ones looked up, and their ids laid out by numpy."""

    def __init__(self, tokenizer: str):
        self.words = WordIds(tokenizer)
        self.size = self.words.tokenizer.get_vocab_size()

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, ``end`` behind each text, and the places where texts end."""
        # The strings of special tokens have their ids in small letters only.
        special = {i: t for i, t in enumerate(texts) if "<|" in t}
        plain = [b"" if i in special else t.encode() for i, t in enumerate(texts)]
        raw = np.frombuffer(b"\n".join(plain) + b"\n", np.uint8).copy()
        raw[(raw >= 65) & (raw <= 90)] += 32
        raw[raw == 10] = 32
        # A word holds the blank behind it, so words are slices of the texts; a text ends with a word.
        stops = np.concatenate([[0], np.flatnonzero(raw == 32) + 1]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(stops) - 1, pa.py_buffer(stops), pa.py_buffer(raw)).dictionary_encode()
        # The distinct words lie one after the other, a blank behind each.
        distinct = words.dictionary.buffers()[2].to_pybytes().decode().split(" ")[: len(words.dictionary)]
        known = self.words.known
        found = list(map(known.get, distinct))
        if None in found:
            self.words.learn([w for w, ids in zip(distinct, found) if ids is None])
            if len(known) < len(distinct) or not all(map(known.__contains__, distinct)):  # the memory was cleared
                self.words.learn(distinct)
            found = [known[w] for w in distinct]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        last = np.searchsorted(stops, np.cumsum([len(p) + 1 for p in plain]))  # words until the end of each text
        which = words.indices.to_numpy()
        lengths = sizes[which]
        # The end id stands behind the last word of a text.
        total = np.concatenate([[0], np.cumsum(lengths)])
        ends = total[last] + np.arange(1, len(texts) + 1)
        out = np.full(int(total[-1]) + len(texts), end, np.uint32)
        mask = np.ones(len(out), bool)
        mask[ends - 1] = False
        begin = (np.cumsum(sizes) - sizes)[which]
        out[mask] = flat[np.repeat(begin - total[:-1], lengths) + np.arange(total[-1])]
        if not special:
            return out, ends
        parts = np.split(out, ends[:-1])
        for i, own in zip(special, self.words.encode(list(special.values()))):
            parts[i] = np.append(np.frombuffer(own, "<u4"), np.uint32(end))
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])


def chunks(texts: list[str], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``size`` characters, or of one longer text."""
    a = 0
    while a < len(texts):
        z, chars = a, 0
        while z < len(texts) and (z == a or chars + len(texts[z]) <= size):
            chars += len(texts[z])
            z += 1
        yield a, z
        a = z


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for serialized ids; empty where there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 4)), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    import zstandard

    options = {"level": LEVEL, "write_checksum": False, "write_content_size": True, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=shared, **options)


def _decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def width_of(tokenizer: str, end: int) -> int:
    """Bytes of an id."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end) < 1 << 16 else 4


def trained_dictionary(docs: DataFrame, tokenizer: str, end: int, text: str = "text", sample: int = SAMPLE) -> bytes:
    short = docs.where(F.octet_length(text).between(1, SAMPLE_BYTES)).select(text_key(text).alias("key"), F.col(text).alias("text"))
    lowest = F.broadcast(short.select("key").distinct().orderBy("key").limit(sample))
    texts = short.join(lowest, "key").groupBy("key").agg(F.min("text").alias("text")).orderBy("key").toPandas()["text"].tolist()
    if not texts:
        return b""
    ids, ends = Encoder(tokenizer).encode(texts, end)
    kind = f"<u{width_of(tokenizer, end)}"
    return train([p.astype(kind).tobytes() for p in np.split(ids, ends[:-1])])


_SEGMENT_DDL = (
    "part int, segment int, first_id {id}, last_id {id}, dictionary_sha256 string, width int, start long, "
    "ids array<{id}>, counts array<long>, offsets array<long>, payload binary"
)


def _frames(docs: DataFrame, tokenizer: str, end: int, width: int, dictionary: bytes, id: str, text: str) -> DataFrame:
    """doc_id, key, n, frame of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compressor = Encoder(tokenizer), _compressor(dictionary)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, z in chunks(texts):
                ids, ends = encoder.encode(texts[a:z], end)
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"an id needs more than {width} bytes")
                raw, stops = memoryview(ids.astype(f"<u{width}").tobytes()), (ends * width).tolist()
                frames = [compressor.compress(raw[i:j]) for i, j in zip([0, *stops[:-1]], stops)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a), pa.array(np.diff(ends, prepend=0)), pa.array(frames, pa.binary())],
                    names=["doc_id", "key", "n", "frame"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("doc_id"), text_key(text).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, key long, n long, frame binary"
    )


def _segments(frames: DataFrame, width: int, dictionary: bytes) -> DataFrame:
    """Segments of frames that are in order within their partition; ``part`` numbers the partitions."""
    sha = hashlib.sha256(dictionary).hexdigest()
    kind = frames.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in _SEGMENT_DDL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, start = 0, 0, 0
        ids: list[pa.Array] = []
        counts: list[int] = []
        sizes: list[int] = []
        payload: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal segment, start
            keys = pa.concat_arrays(ids)
            n = len(keys)
            listed = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), keys)
            offsets = np.cumsum([0, *sizes])
            columns = [
                pa.array([part], pa.int32()), pa.array([segment], pa.int32()), keys.slice(0, 1), keys.slice(n - 1, 1),
                pa.array([sha]), pa.array([width], pa.int32()), pa.array([start], pa.int64()), listed,
                pa.array([counts], pa.list_(pa.int64())), pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([b"".join(payload)], pa.binary()),
            ]
            segment, start = segment + 1, start + sum(counts)
            for held in (ids, counts, sizes, payload):
                held.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            found, n = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            a, held = 0, sum(sizes)
            for i, frame in enumerate(found):
                payload.append(frame)
                sizes.append(len(frame))
                counts.append(n[i])
                held += len(frame)
                if held >= SEGMENT:
                    ids.append(batch.column(1).slice(a, i + 1 - a))
                    a, held = i + 1, 0
                    yield close()
            if a < len(found):
                ids.append(batch.column(1).slice(a))
        if counts:
            yield close()

    return frames.select(F.spark_partition_id().alias("part"), "doc_id", "n", "frame").mapInArrow(run, _SEGMENT_DDL.format(id=kind))


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end: int = 1, id: str = "doc_id", text: str = "text") -> None:
    """Writes the dataset of all documents, in ascending order of ids, to ``folder``."""
    spark = docs.sparkSession
    width = width_of(tokenizer, end)
    dictionary = trained_dictionary(docs, tokenizer, end, text)
    # Encoded once: dealing by ranges reads its input twice.  The row number keeps copies of a row apart.
    frames = _frames(docs, tokenizer, end, width, dictionary, id, text).withColumn("row", F.monotonically_increasing_id())
    frames = materialise(frames, label="frames")
    order = [F.asc_nulls_first("doc_id"), "key", "row"]
    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order)
    _segments(ordered, width, dictionary).write.option("compression", "none").parquet(f"{folder}/segments")
    row = [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))]
    spark.createDataFrame(row, "sha256 string, bytes binary").coalesce(1).write.option("compression", "none").parquet(f"{folder}/dictionary")


def read_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    sha, dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(dictionary).hexdigest() != sha:
        raise ValueError("the dictionary is not the one that was written")
    return sha, bytes(dictionary)


def _decoded(segments: DataFrame, sha: str, dictionary: bytes, kept: str):
    """Rows of ``kept`` (``ids`` or ``digest``) for each document of segments, with the ids of the part before it."""
    kind = segments.schema["first_id"].dataType.simpleString()
    last = "ids array<long>" if kept == "ids" else "ids_crc32 long"
    columns = ["part", "start", "dictionary_sha256", "width", "ids", "counts", "offsets", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = _decompressor(dictionary)
        for batch in batches:
            for i in range(batch.num_rows):
                part, start, hash_, width, _, counts, offsets, payload = (None if c == "ids" else batch.column(k)[i].as_py() for k, c in enumerate(columns))
                if hash_ != sha:
                    raise ValueError("a segment was written with another dictionary")
                out, view = [], memoryview(payload)
                for n, a, z in zip(counts, offsets[:-1], offsets[1:]):
                    raw = decompressor.decompress(view[a:z])
                    if len(raw) != n * width:
                        raise ValueError("a frame has another number of ids than its index says")
                    ids = np.frombuffer(raw, f"<u{width}")
                    out.append(ids.astype(np.int64) if kept == "ids" else zlib.crc32(ids.astype("<u4").tobytes()))
                own = pa.array(out, pa.list_(pa.int64()) if kept == "ids" else pa.int64())
                starts = start + np.cumsum(counts) - counts
                keys = batch.column(4)[i].values
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([part] * len(keys), pa.int32()), pa.array(starts), pa.array(counts, pa.int64()), own],
                    names=["doc_id", "part", "start", "n_tokens", last.split()[0]],
                )

    return segments.select(*columns).mapInArrow(run, f"doc_id {kind}, part int, start long, n_tokens long, {last}")


def _parts(segments: DataFrame) -> DataFrame:
    """part, shift: the ids of all parts before each; as many rows as Spark wrote parts."""
    sums = segments.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n")).orderBy("part").collect()
    shifts = np.cumsum([0, *[r[1] for r in sums]]).tolist()
    return segments.sparkSession.createDataFrame([(r[0], s) for r, s in zip(sums, shifts)], "part int, shift long")


def read_ids(spark: SparkSession, folder: str, kept: str = "ids") -> DataFrame:
    """doc_id, start, n_tokens and ``ids`` or, with ``kept="digest"``, their ids_crc32, of all documents."""
    sha, dictionary = read_dictionary(spark, folder)
    segments = spark.read.parquet(f"{folder}/segments")
    rows = _decoded(segments, sha, dictionary, kept)
    placed = rows.join(F.broadcast(_parts(segments)), "part")
    return placed.select("doc_id", (F.col("start") + F.col("shift")).alias("start"), "n_tokens", rows.columns[-1])


def read_document(spark: SparkSession, folder: str, id: object) -> list[list[int]]:
    """The ids of the documents of one id, from the segments whose range has it; no other frame is decompressed."""
    sha, dictionary = read_dictionary(spark, folder)
    decompressor, out = _decompressor(dictionary), []
    segments = spark.read.parquet(f"{folder}/segments")
    wanted = F.lit(id).cast(segments.schema["first_id"].dataType)
    from_null = F.col("first_id").isNull()
    found = segments.where(from_null if id is None else (from_null | (F.col("first_id") <= wanted)) & (F.col("last_id") >= wanted))

    def cut(i):
        begin, end = F.get("offsets", i), F.get("offsets", i + 1)
        return F.substring(F.col("payload"), (begin + 1).cast("int"), (end - begin).cast("int"))

    places = F.filter(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.get("ids", i).eqNullSafe(wanted))
    rows = found.select("part", "segment", "dictionary_sha256", "width", F.transform(places, cut).alias("frames"))
    for r in rows.orderBy("part", "segment").collect():
        if r["dictionary_sha256"] != sha:
            raise ValueError("a segment was written with another dictionary")
        out.extend(np.frombuffer(decompressor.decompress(f), f"<u{r['width']}").tolist() for f in r["frames"])
    return out


def round_trip(docs: DataFrame, tokenizer: str, end: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the documents' ids and reads them back: doc_id, start, n_tokens, ids_crc32."""
    folder = shared_dir(docs.sparkSession, "token_ids")
    write_ids(docs, tokenizer, folder, end, id, text)
    return read_ids(docs.sparkSession, folder, "digest")
