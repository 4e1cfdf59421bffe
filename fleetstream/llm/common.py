"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstream.session import configure, fresh_path

# White space that separates words: space and the five ASCII controls tab to return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written once to the shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks it was running, not what they read.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Maximal runs of anything but white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def row_key(doc_id: Column, text: Column) -> Column:
    """A key on which equal rows agree, also where the id is null or used twice."""
    return F.xxhash64(doc_id, doc_id.isNull(), text, F.length(text))


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all columns as ``_row``, so that no name can clash."""
    return docs.select("doc_id", "text", F.struct("*").alias("_row"))
