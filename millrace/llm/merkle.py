"""A Merkle manifest of a table: a hash tree over the rows of each group, and one over the groups' roots.

Rows become leaves, numbered in order within their tree.  On each level sixteen consecutive nodes form a run.  A window
over the run gives every node its neighbours at fixed offsets, ``lag`` 1 to 15 and ``lead`` 1 to 15; which of them are
siblings follows from the node's slot in the run and the run's length alone.  The first child of a run hashes the parent.
Levels shrink sixteenfold and each is written once.  On the way down a node's path is its own siblings followed by its
parent's path, so a leaf meets its whole path in one join on its parent.

Numbering needs no window over a tree: leaves are sorted by range partitions, and a leaf's number is its place in the
partition plus the leaves of its tree in the partitions before, of which there are as many rows as partitions per tree.
A tree of any size is therefore never in the hands of one task, nor is a run of equal rows.

A path is an array of ``before`` and ``after``, the concatenated digests left and right of the node, from the leaves up;
folding a leaf's hash through it gives the root that this leaf stands for.

Defined cases: a null field is ``-`` in a leaf and differs from an empty one; rows without a tree form a tree of their own,
which comes first; null order keys come first and equal ones are ordered by leaf; equal rows get places of their own, with
their own paths; a tree of one leaf has no levels and its leaf is the subroot; an empty table gives an empty result;
columns are carried in a struct, so no name of the table clashes with a working name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Children of a node.
FAN = 16
_PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """The hash of a row: each field as its byte count, a colon and its text, or a dash."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(hash: Column, path: Column) -> Column:
    """The root that a leaf's hash leads to along its path."""
    return F.aggregate(path, hash, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(path: Column) -> Column:
    """One hash over all siblings of a path."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))), 256)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, their number in the tree, and ``size``, the tree's number of rows."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # The number that Spark gives rows holds the partition above 33 bits and the place in it below.
    ranged = materialise(ranged.withColumn("at", F.monotonically_increasing_id()), label="leaves")
    ranged = ranged.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    counts = ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("size"))
    placed = ranged.join(counts, ["tree", "part"])
    return placed.withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, size, hash) with their run, what stands ``before`` and ``after`` them in it."""
    nodes = nodes.withColumn("run", F.expr(f"pos DIV {FAN}"))
    slot = F.col("pos") - F.col("run") * FAN
    length = F.least(F.lit(FAN), F.col("size") - F.col("run") * FAN)
    along = Window.partitionBy("tree", "run").orderBy("pos")
    near = nodes.select(
        "*",
        *[F.lag("hash", k).over(along).alias(f"lag{k}") for k in range(1, FAN)],
        *[F.lead("hash", k).over(along).alias(f"lead{k}") for k in range(1, FAN)],
    )
    before = [F.when(slot >= k, F.col(f"lag{k}")) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < length, F.col(f"lead{k}")) for k in range(1, FAN)]
    return near.select(*nodes.columns, F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))


def _levels(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``leaves`` (tree, pos, size, hash), with siblings, and the top node of each tree."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    tops = [leaves.where("size = 1").select("tree", "hash")]
    levels, nodes = [], leaves.select("tree", "pos", "size", "hash")
    while most > 1:
        near = _with_siblings(nodes.where("size > 1"))
        first = near.where(F.col("pos") == F.col("run") * FAN)
        up = first.select("tree", F.col("run").alias("pos"), F.expr(f"(size + {FAN - 1}) DIV {FAN}").alias("size"), digest(F.col("hash"), F.col("after")).alias("hash"))
        nodes = materialise(up, label="level")
        levels.append(nodes)
        tops.append(nodes.where("size = 1").select("tree", "hash"))
        most = -(-most // FAN)
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return levels, out


def _paths(levels: list[DataFrame], crowns: DataFrame) -> DataFrame:
    """tree, pos, path, subroot, root of each node of the first of ``levels``; ``crowns`` are those of the tops, by tree."""
    below: DataFrame | None = None
    for nodes in reversed(levels):
        here = nodes.where("size = 1").join(crowns, "tree").select("tree", "pos", "path", "subroot", "root")
        if below is not None:
            here = here.unionByName(_along(nodes.where("size > 1"), below).select("tree", "pos", "path", "subroot", "root"))
        below = materialise(here, label="paths")
    return below


def _along(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """``nodes`` with their whole path: their own siblings, then the path of the parent."""
    up = parents.select("tree", F.col("pos").alias("run"), F.col("path").alias("rest"), "subroot", "root")
    step = F.array(F.struct("before", "after"))
    return _with_siblings(nodes).join(up, ["tree", "run"]).withColumn("path", F.concat(step, "rest"))


def _crowns(tops: DataFrame) -> DataFrame:
    """tree, path, subroot, root: the tree over the ``tops`` (tree, hash), in the order of their trees."""
    one = tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash")
    placed = materialise(_numbered(one, ["of"]), label="subroots")
    levels, top = _levels(placed)
    bare = F.array().cast(_PATH)
    out = [F.col("of").alias("tree"), "path", F.col("hash").alias("subroot"), "root"]
    alone = placed.where("size = 1").select("of", "hash", bare.alias("path"), F.col("hash").alias("root")).select(*out)
    if not levels:
        return alone
    crown = top.select("tree", bare.alias("path"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    return _along(placed.where("size > 1"), _paths(levels, crown)).select(*out)


def manifest(rows: DataFrame, group: Column, order: list[Column], hash: Column, carry: list[Column]) -> DataFrame:
    """``carry`` of each row with ``leaf``, ``subroot``, ``root`` and ``path``; groups are strings."""
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    keys = [f"key{i}" for i in range(len(order))]
    plain = rows.select(tree.alias("tree"), *[o.alias(k) for o, k in zip(order, keys)], hash.alias("hash"), F.struct(*carry).alias("row"))
    # Equal rows may be many: their row number spreads them over partitions.
    plain = materialise(plain.withColumn("id", F.monotonically_increasing_id()), label="hashed")
    leaves = materialise(_numbered(plain, [*keys, "hash", "id"]).drop(*keys, "id"), label="numbered")
    levels, tops = _levels(leaves)
    crowns = materialise(_crowns(tops), label="crowns")
    out = ["row.*", F.col("hash").alias("leaf"), "subroot", "root", "path"]
    alone = leaves.where("size = 1").join(crowns, "tree").select(*out)
    if not levels:
        return alone
    return _along(leaves.where("size > 1"), _paths(levels, crowns)).select(*out).unionByName(alone)


def lowered(column: str) -> Column:
    """A-Z in small letters; nothing else changes."""
    return F.translate(F.col(column), string.ascii_uppercase, string.ascii_lowercase)


def verify_documents(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, checked after the texts of a fifth of the ids were tampered with."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    own = leaf(*[F.col(f) for f in fields])
    changed = leaf(*[F.col(f) for f in fields[:-1]], lowered("text"))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    found = manifest(docs, F.col("source"), [F.col("doc_id")], own, [F.col("doc_id"), F.when(hit, changed).alias("changed")])
    back = found.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return back.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
