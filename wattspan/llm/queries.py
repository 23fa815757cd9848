"""The operators' registered queries, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (ann, bpe, fingerprints, katz, lines, negatives, packing, passages, pii, quality, simhash, toxicity,
               whitening)
from .common import documents
from .vectors import embeddings

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.query(documents(spark, sf_dir))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.query(documents(spark, sf_dir))


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.query(documents(spark, sf_dir))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.query(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.query(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.query(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.query(embeddings(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.query(embeddings(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.query(embeddings(spark, sf_dir))


def registered() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_katz_backoff": op2_katz_backoff,
        "op3_quality_rules": op3_quality_rules,
        "op4_passage_dedup": op4_passage_dedup,
        "op5_simhash_groups": op5_simhash_groups,
        "op6_line_dedup": op6_line_dedup,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_pii_spans": op8_pii_spans,
        "op9_packing": op9_packing,
        "op10_fingerprints": op10_fingerprints,
        "op11_nearest": op11_nearest,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_whitening": op13_whitening,
    }


def twins() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op12_hard_negatives": negatives.SQL}
