"""The persisted telemetry table: row projection, layout and row lag."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.operators.ranks import index_percentile
from fleetstream.schemas import PERSISTED_FIELDS

EVENT_DATE = "event_date"
BATCH_ID = "batch_id"


def persisted_rows(events: DataFrame, t_persist: datetime | Column) -> DataFrame:
    """Accepted events as table rows; one ``t_persist`` for the whole batch."""
    stamp = t_persist if isinstance(t_persist, Column) else F.lit(t_persist)
    return (
        events.withColumn("t_emit", F.col("ts"))
        .withColumn("t_persist", stamp.cast("timestamp"))
        .withColumn("replica", F.coalesce("replica", F.lit(0)))
        .select(*PERSISTED_FIELDS)
    )


def append_batch(rows: DataFrame, path: str, batch_id: int = 0) -> None:
    """Add one micro-batch to the table at ``path``: by emission date, then batch.

    A date's rows are brought together first, large dates split, so a batch adds one file
    per date unless the date is large.  Only the batch's own directories are overwritten:
    writing it again replaces it.  A reader of some dates lists those dates only.
    """
    (
        rows.withColumn(EVENT_DATE, F.to_date("t_emit"))
        .withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
        .hint("rebalance", EVENT_DATE)
        .sortWithinPartitions(EVENT_DATE, "device_id", "t_emit")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EVENT_DATE, BATCH_ID)
        .parquet(path)
    )


def compact(rows: DataFrame, path: str) -> None:
    """Rewrite many small batches as one table.

    Range partitioning on (date, device, time) splits a date or device that holds a
    large share of the rows over several tasks.
    """
    (
        rows.withColumn(EVENT_DATE, F.to_date("t_emit"))
        .repartitionByRange(EVENT_DATE, "device_id", "t_emit")
        .sortWithinPartitions(EVENT_DATE, "device_id", "t_emit")
        .write.mode("overwrite")
        .partitionBy(EVENT_DATE)
        .parquet(path)
    )


def row_lag(rows: DataFrame, group: Sequence[str] = (), p: float = 0.95) -> DataFrame:
    """Mean, largest and p95 of ``t_persist - t_emit`` in ms."""
    lagged = rows.withColumn(
        "lag_ms", F.unix_millis("t_persist") - F.unix_millis("t_emit")
    ).select(*group, "lag_ms")
    return index_percentile(
        lagged,
        "lag_ms",
        group,
        p,
        name="p95_lag_ms",
        extra={
            "rows": lambda value, n: F.sum(n),
            "mean_lag_ms": lambda value, n: F.sum(value * n) / F.sum(n),
            "max_lag_ms": lambda value, n: F.max(value),
        },
    )
