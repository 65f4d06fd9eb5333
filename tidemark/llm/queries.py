"""One query for each operator, over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import ann_forest, byte_bpe, lm_scoring, merkle, mixing, ngram_join, oracles, periodic_runs, quality, sharding, suffix_dedup, token_counts, token_files, toxicity
from tidemark.llm.documents import load


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(load(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.by_bytes(load(spark, sf_dir))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(load(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op4_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(load(spark, sf_dir, "embeddings"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(load(spark, sf_dir))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(load(spark, sf_dir))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weights(load(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.store_and_read(load(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(load(spark, sf_dir), load(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(load(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(load(spark, sf_dir))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_ngram_join,
        op2_sharding,
        op3_byte_bpe,
        op4_random_projection_forest,
        op5_suffix_dedup,
        op6_context_mixing,
        op7_source_mixing,
        op8_token_counts,
        op9_quality_rules,
        op10_token_files,
        op11_toxic_spans,
        op12_periodic_runs,
        op13_merkle_manifest,
    )
    return {f.__name__: f for f in every}


def all_sql() -> dict[str, str]:
    return {"op7_source_mixing": oracles.mixing_sql(), "op13_merkle_manifest": oracles.manifest_sql()}
