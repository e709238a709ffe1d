"""Fingerprints, versions and states in hashed folders, and orders with ties over many tasks."""

import glob
import os
from collections import Counter

import pytest
from helpers import rows, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import fingerprint, ordering, quality
from millrace.sources import folders

DDL = "a int, b string, c double"
ROWS = [(1, None, 1.0), (None, "1", 1.0), (1, None, 1.0), (2, "", None), (2, None, None)]


def test_fingerprint_counts_rows_and_tells_nulls_apart(spark):
    df = spark.createDataFrame(ROWS, DDL)
    assert quality.same_rows(df, spark.createDataFrame(ROWS[::-1], DDL).repartition(3))
    others = [ROWS[:-1], [*ROWS, ROWS[0]], [*ROWS, ROWS[0], ROWS[0]], [*ROWS[1:], ROWS[1]], [(None, "1", 1.0), *ROWS[1:]]]
    for other in others:
        assert not quality.same_rows(df, spark.createDataFrame(other, DDL)), other
    assert not quality.same_rows(df, df.withColumnRenamed("a", "z"))
    assert quality.same_rows(df.limit(0), spark.createDataFrame([], DDL))


def test_fingerprint_of_nested_values(spark):
    ddl = "x array<int>, s struct<p: int, q: int>, m map<string, int>"
    one = spark.createDataFrame([([None, 1], (None, 1), {"a": 1, "b": 2})], ddl)
    assert quality.same_rows(one, spark.createDataFrame([([None, 1], (None, 1), {"b": 2, "a": 1})], ddl))
    for other in (([1, None], (None, 1), {"a": 1, "b": 2}), ([None, 1], (1, None), {"a": 1, "b": 2}), ([None, 1], (None, 1), {"a": 1, "b": None}), (None, (None, 1), {})):
        assert not quality.same_rows(one, spark.createDataFrame([other], ddl)), other


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", None])), max_size=6), st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", None])), max_size=6))
def test_fingerprint_is_multiset_equality(spark, left, right):
    a, b = (spark.createDataFrame(x, "k int, v string") for x in (left, right))
    assert quality.same_rows(a, b) == (Counter(left) == Counter(right))
    diff = {(r.k, r.v): r.surplus for r in quality.differing_rows(a, b).collect()}
    want = Counter(left)
    want.subtract(Counter(right))
    assert diff == {k: n for k, n in want.items() if n}


def test_fingerprints_of_parts_add_up(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("g"))
    per = df.groupBy("g").agg(*fingerprint.parts(df))
    assert tuple(per.agg(*fingerprint.merged()).first()) == tuple(df.agg(*fingerprint.parts(df)).first())


def test_rerun_gate(spark):
    df = spark.createDataFrame(ROWS, DDL)
    mark = fingerprint.fingerprint(df)
    assert quality.publish(df.repartition(2), quality.Gates(rerun_of=mark)).count() == len(ROWS)
    with pytest.raises(quality.GateError, match="rerun"):
        quality.publish(df.union(df.limit(1)), quality.Gates(rerun_of=mark))


def versions(spark, root, old, new, keys=("k",), n=16):
    for i, data in enumerate((old, new)):
        folders.write_version(spark.createDataFrame(data, "k int, v int"), root, i, list(keys), n)


def test_versions_are_compared_by_the_folders_that_differ(spark, tmp_path):
    root = str(tmp_path / "v")
    old = [(i, i) for i in range(200)]
    new = [(i, -1 if i in (17, 90) else i) for i in range(200) if i != 33] + [(500, 5)]
    versions(spark, root, old, new)
    only = folders.changed_folders(spark, root, 1, 0, 16)
    touched = spark.createDataFrame([(k,) for k in (17, 90, 33, 500)], "k int").select(folders.folder_of(["k"], 16)).distinct()
    assert only == sorted(r[0] for r in touched.collect()) and len(only) <= 4
    diff = folders.diff_versions(spark, root, 1, 0, "k int, v int", ["k"], ["v"], 16)
    assert rows(diff.select("k", "current_v", "original_v")) == [(17, -1, 17), (90, -1, 90)]
    read = {os.path.dirname(f) for f in folders.read_version(spark, root, 1, "k int, v int", 16, only).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert len(read) <= len(only)


def test_an_unchanged_version_costs_no_row(spark, tmp_path):
    root = str(tmp_path / "v")
    data = [(i, i) for i in range(100)]
    versions(spark, root, data, data[::-1])
    assert folders.changed_folders(spark, root, 1, 0, 16) == []
    assert folders.version_mark(spark, root, 0, 16) == folders.version_mark(spark, root, 1, 16)
    before = folders.read_version(spark, root, 1, "k int, v int", 16, [])
    plan = before._jdf.queryExecution().executedPlan().toString()
    assert folders.diff_versions(spark, root, 1, 0, "k int, v int", ["k"], ["v"], 16).count() == 0
    assert "LocalTableScan <empty>" in plan or "PartitionFilters: [false" in plan or before.rdd.getNumPartitions() == 0


STATE = "k int, v string, at timestamp_ntz"


def brute(state, batches):
    held = {k: (at, "S", v) for k, v, at in state}
    for batch in batches:
        best = {}
        for k, op, v, at in batch:
            best[k] = max(best.get(k, (at, "", "")), (at, op, v))
        for k, change in best.items():
            if k not in held or change[0] > held[k][0]:
                held[k] = change
    return sorted((k, v, at) for k, (at, op, v) in held.items() if op != "D")


def test_changes_rewrite_the_folders_of_their_keys_only(spark, tmp_path):
    root, day = str(tmp_path / "s"), lambda i: ts(f"2025-01-{i:02d}")
    state = [(i, f"v{i}", day(5)) for i in range(100)]
    batches = [
        [(3, "U", "new", day(6)), (3, "U", "newer", day(7)), (4, "D", "", day(6)), (5, "U", "stale", day(4)), (5, "U", "tie", day(5))],
        [(4, "U", "late", day(5)), (200, "I", "added", day(1)), (201, "D", "", day(9))],
        [(4, "U", "back", day(8)), (201, "I", "too late", day(8))],
    ]
    folders.write_state(spark.createDataFrame(state, STATE), root, ["k"], folders=32)
    for i, batch in enumerate(batches):
        files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/of-32/folder=*/*.parquet")}
        change = spark.createDataFrame(batch, "k int, op string, v string, at timestamp_ntz")
        n = folders.apply_to_state(change, root, STATE, ["k"], ["v"], "at", folders=32)
        kept = {f for f in files if os.path.exists(f)}
        assert n <= len({b[0] for b in batch}) and len({os.path.dirname(f) for f in files} - {os.path.dirname(f) for f in kept}) <= n
        assert len(kept) >= len(files) - n and all(os.stat(f).st_mtime_ns == files[f] for f in kept)
        want = brute(state, batches[: i + 1])
        assert rows(folders.read_state(spark, root, STATE, folders=32)) == rows(spark.createDataFrame(want, STATE))
        # A batch that runs again changes nothing.
        folders.apply_to_state(change, root, STATE, ["k"], ["v"], "at", folders=32)
        assert rows(folders.read_state(spark, root, STATE, folders=32)) == rows(spark.createDataFrame(want, STATE))
    assert folders.apply_to_state(change.limit(0), root, STATE, ["k"], ["v"], "at", folders=32) == 0


@pytest.mark.parametrize("chunk,heavy,most", [(1, 64, 400), (1, 1 << 20, 400), (4, 64, 700)])
def test_order_with_half_of_the_rows_equal(spark, chunk, heavy, most):
    data = [("m", 1)] * 500 + [(chr(97 + i % 26), i) for i in range(450)] + [(None, 0)] * 50
    df = spark.createDataFrame(data, "k string, v int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ordering.sample_sort(df, ["k"], chunk=chunk, heavy=heavy)
        got = [[tuple(r) for r in p] for p in out.rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    every = [r for p in got for r in p]
    assert Counter(every) == Counter(data)
    keys = [k for k, _ in every]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or ""))
    assert sum(("m", 1) in p for p in got) >= 2 or chunk > 1
    assert max(len(p) for p in got) <= most


@pytest.mark.parametrize("repeated", [True, False])
def test_positions(spark, repeated):
    data = [(i * 7919 % 1000, str(i)) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, v string")
    out = ordering.positions(df, [F.col("k").desc()], repeated=repeated)
    assert rows(out) == sorted((k, v, 1000 - k) for k, v in data)
    assert ordering.positions(df.limit(0), ["k"]).count() == 0
