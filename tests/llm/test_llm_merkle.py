import hashlib
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle as M

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def steps(tree, i):
    for level in tree[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        yield run[: i % 16], run[i % 16 + 1 :]
        i //= 16


def brute(rows):
    """``rows``: doc_id, text, lang, source, n_chars, ..."""
    leaf = lambda r, text: sha(*map(field, (r[0], r[3], r[2], r[4], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for n, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path = [*steps(trees[s], i), *steps(top, n)]
            node = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                node = leaf(r, r[1].translate(LOWER))
            for before, after in path:
                node = sha(*before, node, *after)
            proof = sha(*[x for before, after in path for x in before + after])
            out.append((r[0], own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in M.verify_documents(df).collect())


def test_documents(docs, rows, no_docs):
    found = got(docs)
    assert found == brute(rows)
    assert {r[6] for r in found} == {True, False}
    assert M.verify_documents(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_sizes_and_many_sources(spark, n):
    # Names whose order differs between bytes and UTF-16, an empty one, none, and one that holds most rows.
    sources = [None, "", "=", "é", "\U0001f600", "￮", "a"]
    rows = [(i * 3 % 1000, f"Text {i}", None, "hot" if i % 3 else sources[i % 7] or f"s{i}" if i % 2 else sources[i % 7], i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(df) == brute(rows)


def test_one_source_and_repeated_rows(spark):
    rows = [(1, "Same", "en", "s", 4)] * 40 + [(1, "Other", "en", "s", 5)] * 20 + [(i, "X", "en", "s", 1) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert got(df) == brute(rows)


def test_own_keys_and_clashing_names(spark):
    """Any columns can be carried; a changed row does not lead to the root, an unchanged one does."""
    rows = [(i, f"v{i}", "p" if i % 4 else "q") for i in range(100)]
    df = spark.createDataFrame(rows, "tree long, hash string, path string")
    own = M.leaf(F.col("tree"), F.col("hash"))
    out = M.manifest(df, F.col("path"), [F.col("tree")], own, [F.col("tree").alias("pos"), F.col("hash").alias("before")])
    assert out.columns == ["pos", "before", "leaf", "subroot", "root", "path"]
    assert out.select("root").distinct().count() == 1 and out.select("subroot").distinct().count() == 2
    assert {(r.pos, r.before) for r in out.collect()} == {r[:2] for r in rows}
    assert out.where(M.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 100
    assert out.where(M.fold(M.leaf(F.lit("forged")), F.col("path")) == F.col("root")).count() == 0


def test_windows_stay_in_runs_and_no_task_gets_a_tree(docs):
    plan = M.verify_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag" in plan and "lead" in plan
    for line in plan.splitlines():
        if "windowspecdefinition(tree" in line:
            assert "windowspecdefinition(tree#" in line and "run#" in line
