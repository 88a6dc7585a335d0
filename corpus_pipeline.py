"""From raw documents to token counts: language ID, exact dedup, near dedup, mixing, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import byte_bpe, exact_dedup, language_id, minhash_dedup, mixing
from fieldloom.llm.common import cut, free, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.keep(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over five-word shingles."""
    return minhash_dedup.keep_representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as, and in the order in which, training meets them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return byte_bpe.byte_bpe(docs, *byte_bpe.vocabulary())


STAGES = [("language_id", identified), ("exact_dedup", exact), ("near_dedup", near), ("mix_sources", mixed), ("byte_bpe", encoded)]

#: No SQL expresses the trained network, sketches and merges; the chain is tested against a plain one in Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        free(before)
    return STAGES[-1][1](spark, docs, sf_dir)
