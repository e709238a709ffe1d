"""The operators bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import pin_session
from . import (
    fingerprints,
    jaccard_join,
    language_model,
    licenses,
    merkle,
    packing,
    periodic,
    pieces,
    quality_rules,
    quotations,
    sharding,
    suffix_dedup,
    token_files,
    twins,
)
from .common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {
    "op1_quality_rules": twins.QUALITY_RULES,
    "op8_ngram_jaccard_join": twins.JACCARD_JOIN,
    "op11_merkle_manifest": twins.MERKLE_MANIFEST,
}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, folder: fn(pin_session(spark), folder)
    return fn


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, folder), table(spark, folder, "labels")).drop("text_key")


@query
def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_report(documents(spark, folder))


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.judge(documents(spark, folder), table(spark, folder, "labels")).drop("text_key")


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.link_quotations(table(spark, folder, "conversations"))


@query
def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    like = jaccard_join.Likeness(words=4, percent=85)
    return jaccard_join.link(documents(spark, folder), like).select("doc_id", "n_shingles", "component_id")


@query
def op9_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, folder))


@query
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, folder))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verify_documents(documents(spark, folder))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digest(documents(spark, folder))


@query
def op13_token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
