"""A corpus from raw documents to a mix: filter, deduplicate, decontaminate, mask, mix.

``STAGES`` are functions of (spark, docs, sf_dir); each gets what its predecessor kept,
written as Parquet and read again.  All but the last return the columns of ``documents``;
the last returns how many words of each document the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetstream.llm import decontaminate, mixing, quality_pu, secrets, sigtree
from fleetstream.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_pu.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return sigtree.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.masked(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mixed(docs, ["doc_id", "lang", "n_chars"])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secret_masking),
    ("mixing", mixing_to_weights),
]

# The classifier is fitted and the mix solves a knapsack: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
