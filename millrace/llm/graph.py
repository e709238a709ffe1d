"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), both long; a component is named after one of its nodes.

    Each round every node steps to the neighbour of lowest rank, if that is lower than its own; edges between what became
    one node vanish.  A rank is a hash of the node, the same in all rounds: the star of a large cluster is gone after two
    of them, and paths, whose nodes have ranks in random order, shrink by a constant factor each time.  Edges and steps
    stay distributed; only "any edges left?" reaches the driver.
    """
    left = materialise(edges.select("a", "b").where("a <> b").distinct(), label="edges")
    steps: list[DataFrame] = []
    past = [left]
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(11), c).alias("r"), F.col(c).alias("node"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(rank("b")).alias("low"))
        step = low.select(F.col("a").alias("node"), F.least(F.col("low"), rank("a"))["node"].alias("to"))
        step = materialise(step, label="step")
        steps.append(step)
        moved = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        moved = moved.join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        left = materialise(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), label="edges")
        past.append(left)
    if not steps:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    out = steps[-1].select("node", F.col("to").alias("component"))
    for step in reversed(steps[:-1]):
        later = out.select(F.col("node").alias("to"), "component")
        out = step.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    out = materialise(out, label="components")
    for table in [*past, *steps]:
        discard(table)
    return out
