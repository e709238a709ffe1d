"""Near duplicates by a grouped prefix join on word shingles.

Two sets of similarity ``t`` share a token within their prefixes, the first ``n - ceil(t n) + 1`` tokens of a common
order.  Any order is right; a good one has frequent tokens last.  Tokens that are frequent in a sample of the documents
go to the end and the others are ordered by their hash, so the sample changes the work, never the result.

1. Equal sets collapse into one node.  Nodes of equal prefix and size collapse into one group, so that one entry of the
   index stands for all of them.
2. Groups that share a prefix token are candidates.  Where few groups share it all their pairs are, where many do each
   group meets one of them, the one with most crowded tokens, for it is likely to be what the others are copies of: a
   constant number of pairs for each index entry.  Sizes, positions and the number of
   common prefix tokens bound what a pair can have in common; the pairs that may link are expanded to members, each
   group being represented by its first node, and each node meets the first node of its group.
3. Expanded pairs are verified on the whole sets.  Sets travel to tiles of pairs of one cluster, not to pairs, so a set
   that has many candidates travels once for each block of them.
4. What meets in a crowded token or in a group and is not in one component by now is paired, filtered, expanded and
   verified in a second round.  Pairs are made in their first common token only, by bands of sizes, where the smaller set
   has it early enough for the rests of both to suffice.  What stays out is already reachable, so the components are those of all links.

Sets are compared by 64-bit hashes of shingles.  Nothing of all documents is collected; components are found by
contraction.

Defined cases: empty and null texts, and those without words, have no shingles and are their own component; equal texts
link whatever their number; null ids have a component only through others; repeated ids with different texts are
different nodes; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialise
from .common import kept_rows, text_key
from .graph import components

_M = 0x9E3779B97F4A7C15
_GROUP = 1_000_000
#: Groups that share a token are all paired up to this number; beyond, the second round has what the first leaves.
FEW = 8
#: Nodes of a block and pairs of a tile.
BLOCK, TILE = 200, 10_000
#: One in so many documents is looked at for frequent tokens, and a token in so many of them is frequent.
SAMPLE, FREQUENT, MOST_FREQUENT = 20, 3, 200_000


@dataclass(frozen=True)
class Likeness:
    """Words of a shingle, and the least share of the union in per cent."""

    words: int = 5
    percent: int = 80


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingles:
    """Sorted distinct shingle hashes of texts, many texts at a time."""

    def __init__(self, words: int):
        self.words, self.powers, self.inverse = words, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            return self._of([t.encode() for t in texts])

    def _of(self, texts: list[bytes]) -> list[np.ndarray]:
        k = self.words
        b = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        n = len(b)
        if n > len(self.powers):
            self.powers = np.cumprod(np.full(n, _M, np.uint64))
            self.inverse = np.cumprod(np.full(n, pow(_M, -1, 1 << 64), np.uint64))
        b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
        blank = (b == 32) | ((b >= 9) & (b <= 13))
        edge = np.flatnonzero(np.diff(blank, prepend=True))
        starts, stops = edge[0::2], edge[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b + np.uint64(1)) * self.powers[:n])])
        word = _mix((total[stops] - total[starts]) * self.inverse[starts] + (stops - starts).astype(np.uint64))
        ends = np.cumsum([len(t) + 1 for t in texts])
        cut = np.concatenate([[0], np.searchsorted(starts, ends)])
        if len(word) >= k:
            h = word[: len(word) - k + 1].copy()
            for i in range(1, k):
                h = h * np.uint64(0xD6E8FEB86659FD93) + word[i : len(word) - k + 1 + i]
            h = _mix(h)
        out = []
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if z - a >= k:
                s = np.sort(h[a : z - k + 1])
                keep = np.ones(len(s), bool)
                keep[1:] = s[1:] != s[:-1]
                out.append(s[keep])
            elif z > a:
                one = np.array([z - a], np.uint64)
                for x in word[a:z]:
                    one = one * np.uint64(0xD6E8FEB86659FD93) + x
                out.append(_mix(one))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def _grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    a = 0
    while a < len(texts):
        z, size = a, 0
        while z < len(texts) and (z == a or size + len(texts[z]) <= _GROUP):
            size += len(texts[z])
            z += 1
        yield a, z
        a = z


def _name(s: np.ndarray, salt: int) -> int:
    """63 bits of a set; 0 for the empty one."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        h = _mix(np.array([np.sum(_mix(s + np.uint64(salt))) + np.uint64(len(s) * 0x9E3779B9)], np.uint64))
    return int(h[0] >> np.uint64(1))


def frequent_tokens(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """Sorted hashes, ``MOST_FREQUENT`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, z in _grouped(texts):
                for s in shingles.of(texts[a:z]):
                    yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["token"])

    some = docs.where(F.pmod(F.xxhash64(F.lit(7), text), F.lit(SAMPLE)) == 0).select(text).distinct()
    counts = some.mapInArrow(run, "token long").groupBy("token").count().where(F.col("count") >= FREQUENT)
    top = counts.orderBy(F.desc("count"), "token").limit(MOST_FREQUENT).select("token").toPandas()
    return np.sort(top["token"].to_numpy(np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, like: Likeness, frequent: np.ndarray) -> DataFrame:
    """doc_id, text_key, n, node, grp, rare (no frequent token in the prefix), prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last = Shingles(like.words), shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, z in _grouped(texts):
                sizes, nodes, groups, prefixes, plain = [], [], [], [], []
                for s in shingles.of(texts[a:z]):
                    n = len(s)
                    p = n - (like.percent * n + 99) // 100 + 1 if n else 0
                    head, rare = s, n
                    if len(last) and n:
                        at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                        often = last[at] == s
                        head, rare = np.concatenate([s[~often], s[often]]), n - int(often.sum())
                    head = head[:p]
                    plain.append(rare >= p)
                    sizes.append(n)
                    nodes.append(_name(s, 1))
                    groups.append(_name(np.append(np.sort(head), np.uint64(n)), 2) if n else 0)
                    prefixes.append(head.view(np.int64))
                ends = np.cumsum([0] + [len(p) for p in prefixes])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, z - a),
                        batch.column(1).slice(a, z - a),
                        pa.array(sizes, pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array(groups, pa.int64()),
                        pa.array(plain, pa.bool_()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes), pa.int64())),
                    ],
                    names=["doc_id", "text_key", "n", "node", "grp", "rare", "prefix"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, text_key long, n long, node long, grp long, rare boolean, prefix array<long>"
    return docs.select("doc_id", "text_key", "text").mapInArrow(run, ddl)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """node and its shingles, as bytes, for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, z in _grouped(texts):
                found = shingles.of(texts[a:z])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_name(s, 1) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["node", "shingles"],
                )

    return docs.select("text").mapInArrow(run, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, staged: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Those of ``pairs`` (a, b) that link, by their whole sets.

    Sets travel to tiles of pairs.  A pair belongs to the smallest node that its smaller node is to meet, so the pairs of
    a cluster share tiles; a tile that would hold too many pairs is cut into blocks of its nodes against blocks.  At most
    ``TILE`` pairs, or those of two blocks of ``BLOCK`` nodes, share a tile on average.
    """
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    both = ordered.select(F.col("a").alias("v"), F.col("b").alias("u"), F.lit(True).alias("own")).unionByName(
        ordered.select(F.col("b").alias("v"), F.col("a").alias("u"), F.lit(False).alias("own"))
    )
    low = both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("cluster"))
    cut = ordered.join(staged(low, "clusters").withColumnRenamed("v", "a"), "a")
    sizes = staged(cut.groupBy("cluster").count(), "sizes")
    parts = F.ceil(F.greatest(F.sqrt(2 * F.col("count")) / BLOCK, F.col("count") / TILE))
    place = lambda c: F.pmod(F.xxhash64(F.lit(3), c), parts)
    tiled = cut.join(sizes, "cluster").select(F.xxhash64("cluster", place("a"), place("b")).alias("tile"), "a", "b")
    tiled = staged(tiled, "tiles")
    needed = tiled.select("tile", F.explode(F.array("a", "b")).alias("node")).distinct()
    nothing = F.lit(None)
    have = needed.join(sets, "node").select("tile", F.col("node").alias("a"), nothing.cast("long").alias("b"), "shingles")
    ask = tiled.select("tile", "a", "b", nothing.cast("binary").alias("shingles"))
    rows = have.unionByName(ask).repartition("tile").sortWithinPartitions("tile", F.col("b").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        now = None
        for batch in batches:
            a, b = [], []
            for tile, x, y, blob in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                if tile != now:
                    now, held = tile, {}
                if y is None:
                    held[x] = np.frombuffer(blob.as_py(), np.uint64)
                    continue
                both = np.sort(np.concatenate([held[x], held[y]]))
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _first_meetings(entries: DataFrame, percent: int) -> DataFrame:
    """grp1, grp2 of the groups that are apart and may link, found in the first token they have in common.

    ``entries``: token, grp, place, lo, hi.  Behind the first common token at most what is left of the shorter rest can be
    common, so of a pair the one of smaller size must have that token early, and late entries never meet each other.
    Sizes that may link lie in the same band or the next one: the larger set offers itself to both.
    """
    n, left = F.shiftright("place", 31), F.shiftright("place", 31) - F.pmod("place", F.lit(1 << 31))
    # A little wider than the ratio of sizes, so that rounding cannot put two bands between sizes that may link.
    band = F.floor(F.log(n.cast("double")) / (1.001 * math.log(100 / percent))).cast("long") if percent < 100 else n
    sized = entries.select("token", "grp", "lo", "hi", n.alias("n"), left.alias("left"), band.alias("band"))
    small = sized.where((100 + percent) * F.col("left") >= 2 * percent * F.col("n"))
    large = sized.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    named = lambda frame, k: frame.select("token", "band", *[F.col(c).alias(f"{c}{k}") for c in ("grp", "lo", "hi", "n", "left")])
    below = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("grp1") < F.col("grp2")))
    near = 100 * F.col("n1") >= percent * F.col("n2")
    room = (100 + percent) * F.least("left1", "left2") >= percent * (F.col("n1") + F.col("n2"))
    apart = F.least("lo1", "lo2") < F.greatest("hi1", "hi2")
    met = named(small, 1).join(named(large, 2), ["token", "band"]).where(below & near & room & apart)
    return met.select(F.least("grp1", "grp2").alias("grp1"), F.greatest("grp1", "grp2").alias("grp2")).distinct()


def link(docs: DataFrame, like: Likeness = Likeness(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, component_id: one row per document."""
    percent = like.percent
    plain = docs.select(F.col(id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    rows = materialise(_prefixes(plain, like, frequent_tokens(plain, "text", like.words)), label="prefixes")
    tables: list[DataFrame] = []

    def staged(frame: DataFrame, label: str) -> DataFrame:
        """Written to the shared folder until the components are known."""
        tables.append(materialise(frame, label=label))
        return tables[-1]

    full = rows.where("n > 0")
    nodes = staged(full.groupBy("node", "grp", "n").agg(F.min("doc_id").alias("first")), "nodes")
    groups = nodes.groupBy("grp").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("members"))
    groups = staged(groups, "groups")
    # One entry for each token of a group's prefix; ``place`` holds size and position.
    heads = full.select("grp", "n", "prefix").dropDuplicates(["grp"])
    index = heads.select("grp", "n", F.posexplode("prefix").alias("pos", "token"))
    index = index.select("token", "grp", (F.col("n") * (1 << 31) + F.col("pos")).alias("place"))
    by_token = Window.partitionBy("token")
    shared = index.withColumn("width", F.count(F.lit(1)).over(by_token)).where("width > 1")
    shared = staged(shared, "index")
    few, crowd = shared.where(F.col("width") <= FEW).drop("width"), shared.where(F.col("width") > FEW).drop("width")

    # What the bounds need to know of a group.
    crowded = crowd.groupBy("grp").agg(F.count(F.lit(1)).alias("crowded"))
    last = F.element_at("prefix", -1)
    # Hashes are ordered as unsigned numbers, and frequent tokens come behind all others.
    ends = full.select("grp", "n", F.size("prefix").alias("p"), F.struct(~F.col("rare"), last < 0, last).alias("end"))
    facts = ends.dropDuplicates(["grp"]).join(crowded, "grp", "left").na.fill(0, ["crowded"])
    facts = staged(facts, "facts")

    def paired(one: DataFrame, two: DataFrame) -> DataFrame:
        """grp1, grp2, place1, place2, common: pairs of entries, in both orders of a pair's ids just once."""
        return one.join(two, "token").where("grp1 < grp2").select("grp1", "grp2", "place1", "place2")

    def named(frame: DataFrame, k: int) -> DataFrame:
        return frame.select("token", *[F.col(c).alias(f"{c}{k}") for c in frame.columns if c != "token"])

    def possible(entries: DataFrame, rest: Column) -> DataFrame:
        """grp1, grp2 of those pairs that can link: ``entries`` has grp1, grp2, place1, place2 and ``common``, the
        number of common prefix tokens that it stands for; ``rest`` bounds how many there may be besides."""
        met = entries.groupBy("grp1", "grp2").agg(
            F.sum("common").alias("common"), F.max("place1").alias("place1"), F.max("place2").alias("place2")
        )
        for k in (1, 2):
            own = facts.select(*[F.col(c).alias(f"{c}{k}") for c in facts.columns])
            met = met.join(own, f"grp{k}")
        # Up to the smaller last token all common tokens are in both prefixes; beyond it, what is left of either set
        # can be common.  How far the other prefix reaches there is at least the last token they share.
        reach1 = F.when(F.col("end1") <= F.col("end2"), F.col("p1")).otherwise(F.pmod("place1", F.lit(1 << 31)) + 1)
        reach2 = F.when(F.col("end2") <= F.col("end1"), F.col("p2")).otherwise(F.pmod("place2", F.lit(1 << 31)) + 1)
        most = F.col("common") + rest + F.least(F.col("n1") - reach1, F.col("n2") - reach2)
        can = (100 + percent) * most >= percent * (F.col("n1") + F.col("n2"))
        near = 100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")
        return met.where(can & near).select("grp1", "grp2")

    everyone = paired(named(few, 1), named(few, 2)).withColumn("common", F.lit(1))
    central = crowd.join(facts.where("crowded > 0").select("grp", "crowded"), "grp")
    leads = central.withColumn("lead", F.min(F.struct(-F.col("crowded"), "grp", "place")).over(by_token))
    one, two = F.struct("lead.grp", "lead.place"), F.struct("grp", "place")
    star = leads.where("lead.grp <> grp").select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y"))
    star = star.select(F.col("x.grp").alias("grp1"), F.col("y.grp").alias("grp2"), F.col("x.place").alias("place1"), F.col("y.place").alias("place2"))
    meetings = everyone.unionByName(star.withColumn("common", F.lit(0)))
    between = staged(possible(meetings, F.least("crowded1", "crowded2")), "meetings")
    between = between.join(groups.select(F.col("grp").alias("grp1"), F.col("rep").alias("a"), F.col("members").alias("m1")), "grp1")
    between = between.join(groups.select(F.col("grp").alias("grp2"), F.col("rep").alias("b"), F.col("members").alias("m2")), "grp2")
    within = nodes.join(groups.where("members > 1").select("grp", "rep"), "grp").where("node <> rep")
    first_pairs = between.select("a", "b").unionByName(within.select(F.col("rep").alias("a"), F.col("node").alias("b")))

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among pairs of nodes."""
        pairs = staged(pairs, "pairs")
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = staged(nodes.join(asked, "node", "left_semi").select("node", F.col("first").alias("doc_id")), "wanted")
        chosen = wanted.select("doc_id").distinct()
        found = plain.join(chosen.hint("merge"), plain["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")
        sets = _sets(found, like.words).join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])
        return staged(_verified(pairs, sets, percent, staged), "links")

    links = verified(first_pairs)
    found = components(links)

    # Second round: what meets in a crowded token or in a group, or has met through its representatives only, and is
    # still apart.
    at = nodes.select("node", "grp").join(found, "node", "left")
    at = staged(at.select("node", "grp", F.coalesce("component", "node").alias("component")), "members")
    spans = staged(at.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")), "spans")
    here = crowd.join(spans, "grp")
    here = here.withColumn("apart", F.min("lo").over(by_token) < F.max("hi").over(by_token)).where("apart").drop("apart")
    here = staged(here, "apart")
    met = staged(_first_meetings(here, percent), "met")
    # What candidates have in common, counted on their whole prefixes.
    asked = met.select(F.explode(F.array("grp1", "grp2")).alias("grp")).distinct()
    whole = full.join(asked, "grp", "left_semi").dropDuplicates(["grp"]).select("grp", "n", "prefix")
    whole = staged(whole, "whole")
    for k in (1, 2):
        met = met.join(whole.select(*[F.col(c).alias(f"{c}{k}") for c in whole.columns]), f"grp{k}")
    met = met.withColumn("both", F.array_intersect("prefix1", "prefix2")).withColumn("last", F.element_at("both", -1))
    place = lambda k: F.col(f"n{k}") * (1 << 31) + F.array_position(f"prefix{k}", F.col("last")) - 1
    met = met.select("grp1", "grp2", place(1).alias("place1"), place(2).alias("place2"), F.size("both").alias("common"))
    apart = spans.where("lo < hi").select(F.col("grp").alias("grp1"), F.col("grp").alias("grp2"))
    left = at.select(F.col("grp").alias("grp1"), F.col("node").alias("x"), F.col("component").alias("cx"))
    right = at.select(F.col("grp").alias("grp2"), F.col("node").alias("y"), F.col("component").alias("cy"))
    others = between.where("m1 > 1 OR m2 > 1").select("grp1", "grp2")
    both = possible(met, F.lit(0)).unionByName(apart).unionByName(others).distinct()
    expanded = both.join(left, "grp1").join(right, "grp2").where("cx <> cy AND (grp1 <> grp2 OR x < y)")
    second_pairs = staged(expanded.select(F.col("x").alias("a"), F.col("y").alias("b")), "pairs")
    if not second_pairs.isEmpty():
        tables.append(found)
        found = components(links.unionByName(verified(second_pairs)))
    for table in tables:
        discard(table)

    # The smallest id of each component; components are hot keys, so ids are pre-aggregated and joined back.
    known = rows.select("doc_id", "text_key", "n", "node").join(found, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    lowest = known.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    out = known.join(lowest, "component", "left")
    own = F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, like: Likeness = Likeness(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of smallest id of each component, once, with all columns.  Documents without ids stay unless a
    component with an id holds them."""
    rows = link(docs, like, id, text).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = materialise(rows.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), label="kept")
    out = kept_rows(docs, rows, id, text)
    if rows.where("_id IS NOT NULL").groupBy("_id", "_key").count().where("count > 1").isEmpty():
        return out
    # Repeated rows: one stays.
    names = docs.columns
    held = [f"c{i}" for i in range(len(names))]
    key, body = held[names.index(id)], held[names.index(text)]
    plain = out.toDF(*held).withColumn("_k", text_key(body))
    once = plain.where(F.col(key).isNotNull()).dropDuplicates([key, "_k"]).unionByName(plain.where(F.col(key).isNull()))
    return once.drop("_k").toDF(*names)
