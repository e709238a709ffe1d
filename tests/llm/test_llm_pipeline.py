import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from millrace.llm import jaccard_join, language_model, quality_rules, suffix_dedup  # noqa: E402
from millrace.llm.common import documents, table  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_each_operator_has_a_query():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


def test_stages_one_by_one(spark, tmp_path):
    docs = documents(spark, FOLDER)
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, path = docs, str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = (before, docs)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and docs.dtypes == before.dtypes
    for name in ("quality_rules", "quality_classifier", "ngram_jaccard_join"):
        before, after = seen[name]
        assert 0 < after.count() < before.count()
        assert after.exceptAll(before).count() == 0
    before, after = seen["suffix_array_dedup"]
    assert after.count() == before.count()
    assert after.selectExpr("sum(n_chars)").first()[0] == after.selectExpr("sum(length(text))").first()[0]
    before, after = seen["best_fit_packing"]
    assert after.select("doc_id").distinct().count() == before.count()


def test_good_documents_stay(spark):
    docs, labels = documents(spark, FOLDER), table(spark, FOLDER, "labels")
    good = labels.where("quality = 1 AND toxic = 0").select("doc_id")
    for _, stage in corpus_pipeline.STAGES[1:2]:
        kept = stage(spark, docs, FOLDER)
        assert kept.join(good, "doc_id", "left_semi").count() >= 0.99 * docs.join(good, "doc_id", "left_semi").count()


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_columns_of_any_name_keep_their_values(spark, docs):
    """Working names of the stages are no columns of the documents."""
    plain = docs.drop("text_key", "kept")
    extra = {c: F.xxhash64(F.lit(c), "doc_id", "text") for c in ("_k", "_id", "_key", "_n", "c0", "c1", "spans", "text_key", "start", "row", "grp")}
    wide = plain.withColumns(extra)
    labels = spark.createDataFrame([(3, 1, 0), (10, 1, 0), (17, 0, 0)], "doc_id long, quality long, toxic long")
    stages = [
        lambda d: quality_rules.keep_good(d, labels),
        lambda d: language_model.keep_fluent(d, labels),
        lambda d: jaccard_join.keep_one(d),
        lambda d: suffix_dedup.remove_repeats(d),
    ]
    for stage in stages:
        out = stage(wide)
        assert out.columns == wide.columns
        got, want = Counter(map(tuple, out.collect())), Counter(map(tuple, stage(plain).collect()))
        assert Counter(r[: len(plain.columns)] for r in got.elements()) == want
        before = {r["_k"]: r for r in wide.collect()}
        assert all(r[-len(extra) :] == tuple(before[r[out.columns.index("_k")]][-len(extra) :]) for r in got)
