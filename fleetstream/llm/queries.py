"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstream.llm import (
    decontaminate,
    golay,
    merkle,
    mixing,
    quality_pu,
    repeats,
    reputation,
    rules,
    secrets,
    sigtree,
    spelling,
    tokencache,
    wrapper,
)
from fleetstream.llm.common import table
from fleetstream.llm.oracle import ORACLES

__all__ = ["ORACLES", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.joined(table(spark, sf_dir, "documents"))


def op6_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extracted(table(spark, sf_dir, "pages"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencache.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label that carries its id."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return reputation.verdicts(table(spark, sf_dir, "pages"), outcomes).drop("bound")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows is checked with a changed text."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.report(table(spark, sf_dir, "documents"), tampered)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay.grouped(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality": op2_quality,
    "op3_repeats": op3_repeats,
    "op4_rules": op4_rules,
    "op5_jaccard": op5_jaccard,
    "op6_wrapper": op6_wrapper,
    "op7_tokens": op7_tokens,
    "op8_reputation": op8_reputation,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_golay": op13_golay,
}
