"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    decontam, line_dedup, line_quality, lm_score, mixing, ngram_join, pii, suffix_dedup, token_alignment, training_order, url_reputation, warc, whitening,
)
from .common import table


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.url_reputation(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_equal", "n_near", F.array_join("removed", ",").alias("removed"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_order(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"))


def op8_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_reputation": op1_url_reputation,
    "op2_warc": op2_warc,
    "op3_personal_data": op3_personal_data,
    "op4_line_dedup": op4_line_dedup,
    "op5_line_quality": op5_line_quality,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_training_order": op7_training_order,
    "op8_fair_mix": op8_fair_mix,
    "op9_decontaminate": op9_decontaminate,
    "op10_ngram_join": op10_ngram_join,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_lm_score": op13_lm_score,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_reputation": url_reputation.ORACLE,
    "op2_warc": warc.ORACLE,
    "op5_line_quality": line_quality.ORACLE,
    "op8_fair_mix": mixing.ORACLE,
    "op9_decontaminate": decontam.ORACLE,
}
