"""Live percentiles of a stream from mergeable sketches, one per group and micro-batch.

A sketch has a fixed size, whatever number of values it has seen, and sketches of batches merge
into that of all of them.  ``rank_error`` measures a percentile against the exact ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetstream.functions.rows import null_safe_join
from fleetstream.streaming.persist import batch_path, read_table

SKETCHES = "sketches"
# With 400 values a level, ranks are within 0.01 with 99 % confidence.
SIZE = 400
STATED_ERROR = 0.01


def sketch_writer(
    root: str, value: str, group: Sequence[str] = (), size: int = SIZE
) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer of one sketch of ``value`` per group; a replay overwrites its batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy(*group).agg(
            F.count(value).alias("rows"),
            F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), size).alias("sketch"),
        )
        rows.write.mode("overwrite").parquet(batch_path(root, SKETCHES, batch_id))

    return write


def sketch_stream(
    source: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def merged_percentile(
    spark: SparkSession,
    root: str,
    group: Sequence[str] = (),
    p: float = 0.95,
    name: str = "percentile",
) -> DataFrame:
    """The percentile per group over all batches so far, with the rows it stands for."""
    merged = (
        read_table(spark, root, SKETCHES)
        .where("rows > 0")
        .groupBy(*group)
        .agg(F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    )
    return merged.select(*group, "rows", F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(name))


def rank_error(
    df: DataFrame, value: str, told: DataFrame, name: str, group: Sequence[str], p: float = 0.95
) -> DataFrame:
    """How far the ranks of a told value are from ``p``, per group, as shares of the rows.

    A value that occurs often has all ranks from the share of rows below it to the share not
    above it.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("__v"))
    placed = null_safe_join(rows, told, list(group))
    return placed.groupBy(*group).agg(
        F.greatest(
            F.avg((F.col("__v") < F.col(name)).cast("double")) - F.lit(p),
            F.lit(p) - F.avg((F.col("__v") <= F.col(name)).cast("double")),
            F.lit(0.0),
        ).alias("rank_error")
    )
