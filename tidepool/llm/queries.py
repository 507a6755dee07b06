"""The registered corpus queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    filter_audit,
    importance,
    language_id,
    minhash_dedup,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    quotes,
    sharding,
)
from tidepool.llm.common import read_table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op9_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(read_table(spark, sf_dir, "conversations"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_language_id,
        op3_packing,
        op4_embedding_dedup,
        op5_bpe,
        op6_quality_rules,
        op7_sharding,
        op8_quality_classifier,
        op9_chat_quotes,
        op10_pii,
        op11_importance_resampling,
        op12_decontamination,
        op13_filter_audit,
    )
}

ORACLES: dict[str, str] = {
    "op9_chat_quotes": quotes.ORACLE_SQL,
    "op11_importance_resampling": importance.ORACLE_SQL,
    "op12_decontamination": decontaminate.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
