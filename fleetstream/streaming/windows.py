"""Windowed alerts on a stream: the native operator and the exact one.

The native operator drops late events at micro-batch granularity.  The exact one drops
each event that arrives after a larger window key, also inside a micro-batch.  After a
micro-batch only the window with the largest key can still be open, so its partial
aggregates are the whole state: one row, written with the batch and read by the next.

What a micro-batch did is observed on the rows that it writes: events received, accepted and
late, the latency histogram of the windows it closed and the mean of the last one.  It costs no
pass of its own, and it is stored with the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from fleetstream.operators.windows import (
    KEY,
    LATENCY_BOUNDS_S,
    WINDOW_MS,
    accepted_buffers,
    alert_lines,
    close_index,
    finish_windows,
    first_arrivals,
    merged_buffers,
    window_buffers,
    window_key,
    with_latency,
)
from fleetstream.session import with_setting
from fleetstream.streaming.persist import batch_path, read_table

EVENT_COLUMNS = ["seq", "arrival_ms", "t_emit", "engineTemperature", "tyresSurfaceTemperature"]
BUFFERS = [
    "count",
    "sum_engine",
    "sum_tyre",
    "top_engine",
    "top_tyre",
    "earliest_t_emit",
    "latest_t_emit",
]
STATE = "windows"
COUNTS = "counts"
# ``observations`` are cumulative, one per bound and one for all closed windows.
COUNTS_SCHEMA = (
    "received bigint, accepted bigint, late bigint, observations array<bigint>, sum_ms bigint, "
    "latest_key bigint, latest_mean double"
)


def single_operator(spark: SparkSession) -> AbstractContextManager[None]:
    """Start a query as one with a single stateful operator; the setting is put back after."""
    return with_setting(spark, "spark.sql.streaming.statefulOperator.allowMultiple", "false")


def native_windows(events: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Closed windows of an event stream under a watermark without delay.

    Started inside ``single_operator``, the current watermark also filters late rows, which
    drops events of windows closed by an earlier micro-batch.  Equal to the exact operator
    for events that arrive in order.
    """
    stamped = events.withColumn("ts", F.timestamp_millis("t_emit"))
    buffers = (
        stamped.withWatermark("ts", "0 seconds")
        .groupBy(F.window("ts", f"{size_ms} milliseconds"))
        .agg(*window_buffers())
    )
    key = F.expr(f"unix_millis(window.start) div {int(size_ms)}L")
    return finish_windows(buffers.withColumn(KEY, key), size_ms)


def exact_window_writer(
    root: str,
    size_ms: int = WINDOW_MS,
    decode: Callable[[DataFrame], DataFrame] | None = None,
    bounds_s: Sequence[float] = tuple(LATENCY_BOUNDS_S),
) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer of window rows and of what was observed, below ``root``.

    A batch writes the windows it closed and the one left open under its own id in a single
    overwrite, and reads the open row of the batch before it.  Replaying a batch therefore
    gives the same result.  ``decode`` turns the source rows into events with
    ``EVENT_COLUMNS``.
    """

    def write(source: DataFrame, batch_id: int) -> None:
        spark = source.sparkSession
        events = (decode(source) if decode else source).select(EVENT_COLUMNS)
        held: list[DataFrame] = []

        def hold(df: DataFrame) -> DataFrame:
            # Needed for this micro-batch only: a cache, which is computed again if lost.
            held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return held[-1]

        events = hold(events)
        try:
            carry = None
            if batch_id > 0:
                before = spark.read.parquet(batch_path(root, STATE, batch_id - 1))
                carry = before.where(~F.col("closed"))
            merged = _advance(events, carry, size_ms, hold)
            seen = Observation(f"windows-{uuid.uuid4().hex}")
            observed = merged.observe(seen, *_observed(bounds_s))
            observed.write.mode("overwrite").parquet(batch_path(root, STATE, batch_id))
            counts = spark.createDataFrame([_counts_row(seen.get, len(bounds_s))], COUNTS_SCHEMA)
            counts.coalesce(1).write.mode("overwrite").parquet(batch_path(root, COUNTS, batch_id))
        finally:
            for df in held:
                df.unpersist()

    return write


def _observed(bounds_s: Sequence[float]) -> list[Column]:
    """Metrics of a micro-batch over the window rows that it writes."""
    latency_ms = F.when(F.col("closed"), F.col("closed_at_ms") - F.col("earliest_t_emit"))
    closed_key = F.when(F.col("closed"), F.col(KEY))
    return [
        F.sum("received").alias("received"),
        F.sum("accepted").alias("accepted"),
        *(F.count_if(latency_ms / 1000.0 <= bound).alias(f"b{i}") for i, bound in enumerate(bounds_s)),
        F.count(latency_ms).alias(f"b{len(bounds_s)}"),
        F.sum(latency_ms).alias("sum_ms"),
        F.max(closed_key).alias("latest_key"),
        F.max_by(F.col("sum_engine") / F.col("count"), closed_key).alias("latest_mean"),
    ]


def _counts_row(seen: dict, bounds: int) -> tuple:
    received, accepted = (seen.get(name) or 0 for name in ("received", "accepted"))
    observations = [seen.get(f"b{i}") or 0 for i in range(bounds + 1)]
    latest = (seen.get("latest_key"), seen.get("latest_mean"))
    return (received, accepted, received - accepted, observations, seen.get("sum_ms") or 0, *latest)


def _before_all(kind: T.DataType) -> Column:
    """An arrival that is earlier than every real one, of the type of ``seq``."""
    if isinstance(kind, T.StructType):
        return F.struct(*(_before_all(f.dataType).alias(f.name) for f in kind.fields)).cast(kind)
    return F.lit(-1).cast(kind)


def _advance(
    events: DataFrame,
    carry: DataFrame | None,
    size_ms: int,
    hold: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Window rows after a micro-batch, given the open window before it.

    One more row, without a window, has the number of events received.
    """
    # At most one row by construction; none before the first event of the stream.
    open_row = carry.first() if carry is not None else None
    every = hold(first_arrivals(events, size_ms))
    if open_row is None:
        fresh, firsts = events, every
    else:
        open_key = open_row[KEY]
        fresh = events.where(window_key("t_emit", size_ms) >= open_key)
        firsts = every.where(F.col(KEY) >= open_key)
        # The open window arrived before everything in this batch.
        seed = carry.select(
            KEY,
            F.lit(0).cast("bigint").alias("n"),
            _before_all(firsts.schema["first_seq"].dataType).alias("first_seq"),
            F.lit(None).cast("bigint").alias("first_arrival_ms"),
        )
        firsts = (
            firsts.unionByName(seed)
            .groupBy(KEY)
            .agg(
                F.sum("n").alias("n"),
                F.min("first_seq").alias("first_seq"),
                F.min("first_arrival_ms").alias("first_arrival_ms"),
            )
        )
    index = close_index(firsts, hold)
    buffers = accepted_buffers(fresh, index, size_ms).drop("closed_at_ms")
    parts = buffers.withColumn("accepted", F.col("count"))
    if open_row is not None:
        held = carry.select(KEY, *BUFFERS, F.lit(0).cast("bigint").alias("accepted"))
        parts = parts.unionByName(held)
    merged = parts.groupBy(KEY).agg(*merged_buffers(), F.sum("accepted").alias("accepted"))
    rows = index.join(merged, ["closed_at_ms"]).withColumn("closed", F.col("closed_at_ms").isNotNull())
    total = every.agg(F.sum("n").alias("received"))
    return rows.unionByName(total, allowMissingColumns=True)


def window_stream(
    source: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def closed_windows(spark: SparkSession, root: str, size_ms: int = WINDOW_MS) -> DataFrame:
    """Windows closed so far, with closing time and latency."""
    rows = read_table(spark, root, STATE).where("closed")
    return with_latency(finish_windows(rows, size_ms, ["closed_at_ms"]))


def open_window(
    spark: SparkSession, root: str, last_batch_id: int, flush_at_ms: int, size_ms: int = WINDOW_MS
) -> DataFrame:
    """The window still open after a batch, as if closed at ``flush_at_ms``."""
    rows = spark.read.parquet(batch_path(root, STATE, last_batch_id)).where("NOT closed")
    flushed = rows.withColumn("closed_at_ms", F.lit(flush_at_ms).cast("bigint"))
    return with_latency(finish_windows(flushed, size_ms, ["closed_at_ms"]))


def closed_alerts(spark: SparkSession, root: str, size_ms: int = WINDOW_MS) -> DataFrame:
    """Alert lines of the windows closed so far, with the batch that closed each."""
    rows = read_table(spark, root, STATE).where("closed")
    closed = with_latency(finish_windows(rows, size_ms, ["closed_at_ms", "batch_id"]))
    return alert_lines(closed)


def window_counts(spark: SparkSession, root: str) -> DataFrame:
    """What was observed per batch: events, latency histogram and the last window's mean."""
    return read_table(spark, root, COUNTS)


def observed_metrics(counts: DataFrame, bounds_s: Sequence[float] = tuple(LATENCY_BOUNDS_S)) -> DataFrame:
    """Per batch the metrics as ``metric, value`` rows, named like the service's own."""
    labels = [*(str(bound) for bound in bounds_s), "+Inf"]
    named = {
        "received": F.col("received"),
        "accepted": F.col("accepted"),
        "late": F.col("late"),
        **{f"latency_le_{label}": F.col("observations")[i] for i, label in enumerate(labels)},
        "latency_sum_ms": F.col("sum_ms"),
        "latest_mean": F.col("latest_mean"),
    }
    rows = (F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in named.items())
    return counts.select("batch_id", F.inline(F.array(*rows))).where("value is not null")
