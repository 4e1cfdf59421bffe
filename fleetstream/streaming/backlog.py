"""Files and bytes that a file stream has yet to read, batch by batch.

What a micro-batch reads is observed on its rows: the first row of every file stands for the file.
It is then set against what has landed, so that the effect of an admission limit
(``maxFilesPerTrigger``) on the backlog can be seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CONSUMED = "consumed"


def counting_files(source: DataFrame) -> DataFrame:
    """A stream of Parquet files that observes the files and bytes each batch reads.

    Files without rows are not seen.
    """
    first = F.col("_metadata.row_index") == 0
    return source.observe(
        CONSUMED,
        F.count_if(first).alias("files"),
        F.coalesce(F.sum(F.when(first, F.col("_metadata.file_size"))), F.lit(0)).alias("bytes"),
    )


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of the Parquet files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length")


def backlog(progress: DataFrame, landed: DataFrame) -> DataFrame:
    """Per query and batch: files and bytes read by it, and what was left of ``landed`` after."""
    kind = f"`{CONSUMED}` struct<files: bigint, bytes: bigint>"
    read = progress.select(
        "query_id", "batch_id", "input_rows", F.from_json("observed", kind)[CONSUMED].alias("seen")
    ).where("input_rows > 0")
    so_far = Window.partitionBy("query_id").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    total = landed.agg(
        F.struct(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    ).scalar()
    return read.select(
        "query_id",
        "batch_id",
        "input_rows",
        F.col("seen.files").alias("files_read"),
        F.col("seen.bytes").alias("bytes_read"),
        (total["files"] - F.sum("seen.files").over(so_far)).alias("files_left"),
        (total["bytes"] - F.sum("seen.bytes").over(so_far)).alias("bytes_left"),
    )
