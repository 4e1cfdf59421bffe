"""Deliveries of an at-least-once stream, each event kept once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetstream.operators.quality import EVENT_KEY
from fleetstream.streaming.metrics import observed_totals

# Name under which deliveries are observed before repeated ones are dropped.
DELIVERED = "delivered"


def distinct_deliveries(
    events: DataFrame, delay: str, key: Sequence[str] = EVENT_KEY, arrival: str = "arrival"
) -> DataFrame:
    """The first delivery of every key, repeated within ``delay`` of arrival time.

    A key is remembered for ``delay`` beyond the latest arrival seen, so the state is bounded
    by what arrives in that time.  All deliveries are observed on their way in.
    """
    counted = events.observe(DELIVERED, F.count(F.lit(1)).alias("total"))
    return counted.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(list(key))


def delivery_stream(distinct: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Stream writer of the kept deliveries; choose a trigger and start it."""
    return (
        distinct.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    )


def delivery_summary(kept: DataFrame, progress: DataFrame) -> DataFrame:
    """Total deliveries, distinct keys and the difference, from the output and the progress."""
    total = observed_totals(progress, DELIVERED, ["total"])
    distinct = kept.agg(F.count(F.lit(1)).alias("distinct"))
    return total.select(
        "total", distinct.scalar().alias("distinct"), (F.col("total") - distinct.scalar()).alias("duplicates")
    )
