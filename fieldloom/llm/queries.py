"""The corpus operators' queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_dedup, hilbert_shards, language_id, line_dedup, media, minhash_dedup, mixing, secret_scan, url_filter
from .common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.training_plan(table(spark, sf_dir, "documents"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"), with_media=False)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.byte_bpe(table(spark, sf_dir, "documents"), *byte_bpe.vocabulary())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_dedup(table(spark, sf_dir, "documents"), width=4, percent=80)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_mix_sources, op2_media_columns, op3_line_dedup, op4_hilbert_shards, op5_url_reputation, op6_byte_bpe, op7_language_id, op8_near_dedup, op9_secret_scan, op10_exact_dedup)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mixing.ORACLE, "op3_line_dedup": line_dedup.ORACLE, "op5_url_reputation": url_filter.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE}
