"""A corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard_join, language_model, packing, quality_rules, suffix_dedup
from millrace.llm.common import documents, table
from millrace.session import pin_session, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the certified quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def fluency(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents beyond the perplexity of trusted text of their language go."""
    return language_model.keep_fluent(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share four fifths of their shingles of five words one stays."""
    return jaccard_join.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur twice are cut out; a document that loses all of its text stays, empty."""
    cut = suffix_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("quality_classifier", fluency),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("best_fit_packing", packed),
]

#: No SQL: a language model, suffix order and packing are among the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
