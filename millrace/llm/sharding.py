"""A uniform shuffle into shards of exact sizes, without moving more than one exchange for each permutation.

The rows are dealt into buckets by a hash of their content.  How many rows of each bucket go to each cell of the output
is drawn beforehand from the multivariate hypergeometric distribution, as it would come out if all rows were shuffled
at once: row by row of the communication matrix, each entry given the capacity that is left.  Every bucket permutes its
rows and sends them along by the matrix; every cell permutes what it received.  Cells are consecutive ranges of slots of
a shard, so the slots have no gaps and a shard of any size is never in the hands of one task.

Only bucket sizes reach the driver: at most ``MOST_PARTS`` of them, and as many cells beside them, so the matrix that is
sent to the executors has a proven bound.  Rows are written with a row number first; all orders are hashes of the seed
and this number, so a task that runs again gives the same rows, and copies of one row are spread like any others.

Defined cases: a null text has no bytes; repeated rows are rows of their own and get slots of their own; null ids are
fine; an empty table gives an empty result; fewer rows than shards leave shards empty, counts at most one apart.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Buckets and cells, each; the matrix has at most a million entries.
MOST_PARTS = 1024
#: Rows of a bucket or cell, until there are ``MOST_PARTS`` of them; from there on they grow with the table.
PART_ROWS = 4_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows, taken without replacement, are good.  Inverse distribution function around the mode,
    with logarithms of factorials, so that counts beyond those that numpy takes work as well."""
    low, high = max(0, draws - bad), min(draws, good)
    if low >= high:
        return low
    total = good + bad
    mean = draws * good / total
    spread = math.sqrt(max(1.0, mean * (bad / total) * (total - draws) / max(1, total - 1)))
    a, b = max(low, math.floor(mean - 12 * spread) - 12), min(high, math.ceil(mean + 12 * spread) + 12)
    # ratio of neighbouring terms: P(k + 1) / P(k)
    k = np.arange(a, b, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(sizes: list[int], capacities: list[int], seed: int) -> list[list[int]]:
    """Counts from each bucket (rows) to each cell (columns): rows sum to ``sizes``, columns to ``capacities``."""
    rng, left, matrix = np.random.default_rng(seed), list(capacities), []
    for size in sizes:
        row, open_slots, todo = [], sum(left), size
        for j, room in enumerate(left):
            take = hypergeometric(rng, room, open_slots - room, todo)
            row.append(take)
            open_slots, todo = open_slots - room, todo - take
            left[j] = room - take
        matrix.append(row)
    return matrix


def even(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def cells_of(rows: int, shards: int, part_rows: int = PART_ROWS) -> list[tuple[int, int, int]]:
    """(shard, first slot, slots) of each cell."""
    out = []
    for shard, size in enumerate(even(rows, shards)):
        parts, at = max(1, min(math.ceil(size / part_rows), MOST_PARTS // shards)), 0
        for n in even(size, parts):
            out.append((shard, at, n))
            at += n
    return out


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 20, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long)."""
    spark, names = rows.sparkSession, rows.columns
    plain = [F.col(c).alias(f"c{i}") for i, c in enumerate(names)]
    rows = materialise(rows.select(*plain, F.monotonically_increasing_id().alias("_row")), label="rows")
    draw = lambda salt: F.xxhash64(F.lit(seed * 1000 + salt), F.col("_row"))
    total = rows.count()
    buckets = min(MOST_PARTS, max(1, math.ceil(total / part_rows)))
    dealt = rows.withColumn("_bucket", F.pmod(draw(0), F.lit(buckets)).cast("int"))
    sizes = {r[0]: r[1] for r in dealt.groupBy("_bucket").count().collect()}
    cells = cells_of(total, shards, part_rows)
    matrix = communication_matrix([sizes.get(b, 0) for b in range(buckets)], [c[2] for c in cells], seed)
    routes = [
        (b, [(int(a + n), j, cells[j][0], int(cells[j][1])) for j, (a, n) in enumerate(zip(np.cumsum([0, *row]).tolist(), row)) if n])
        for b, row in enumerate(matrix)
    ]
    lists = spark.createDataFrame(routes, "_b int, _routes array<struct<upto: long, cell: int, shard: int, first: long>>")
    local = Window.partitionBy("_bucket").orderBy(draw(1), "_row")
    ranked = dealt.withColumn("_rank", F.row_number().over(local).cast("long") - 1)
    sent = ranked.join(F.broadcast(lists), F.col("_bucket") == F.col("_b"))
    sent = sent.withColumn("_to", F.get(F.filter("_routes", lambda r: F.col("_rank") < r["upto"]), F.lit(0)))
    sent = sent.select(*[f"c{i}" for i in range(len(names))], "_row", "_to.*")
    placed = Window.partitionBy("cell").orderBy(draw(2), "_row")
    slot = F.col("first") + F.row_number().over(placed).cast("long") - 1
    return sent.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "shard", slot.alias("slot"))


def shard_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = 24, seed: int = 20) -> DataFrame:
    """The digest of a sharding: no text is moved."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    return shuffle_into_shards(narrow, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
