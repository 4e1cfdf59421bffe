"""Alert latency and recovery time while the stream runs.

Both give the rows of their batch twins in ``operators.latency``, each as soon as the watermark
says that nothing earlier can arrive.  Spark takes a watermark from the rows that reach the
stateful operator, so a quiet stream needs a line from time to time to move it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetstream.operators.latency import (
    RECOVERY_LIMIT_S,
    first_marks,
    log_marks,
    measured_latency,
)
from fleetstream.session import with_setting


def alert_latency_stream(
    lines: DataFrame,
    starts: DataFrame,
    *,
    limit: str = "10 minutes",
    delay: str = "0 seconds",
    window_ms: int = 10_000,
    critical_max: int = 1500,
) -> DataFrame:
    """``operators.latency.alert_latency`` of two streams.

    ``lines`` also have ``at``, the time of a line, and ``starts`` have ``started_at``.  A run's
    marks are those within ``limit`` of its start, so both sides of the join forget a run after
    that time, and its row is emitted then: with its first injection and alerts, or without any.
    """
    marks = log_marks(lines, critical_max, "at").withWatermark("at", delay)
    marks = marks.withColumnRenamed("run_id", "mark_run")
    run = ["run_id", "run_date", "started_s", "started_at"]
    # A start told again would meet every mark of its run again.
    begun = starts.select(run).withWatermark("started_at", delay).dropDuplicates(run)
    near = (
        (F.col("run_id") == F.col("mark_run"))
        & (F.col("at") >= F.col("started_at"))
        & (F.col("at") <= F.col("started_at") + F.expr(f"INTERVAL {limit}"))
    )
    # Only the start's time goes on, as the event time of the aggregation.
    joined = begun.join(marks, near, "left").drop("at", "mark_run")
    found = joined.groupBy(*run).agg(*first_marks())
    return found.select("run_id", *measured_latency(window_ms))


STATE_SCHEMA = (
    "baseline bigint, value_1 bigint, tick_1 bigint, value_2 bigint, tick_2 bigint, "
    "due_ms bigint, end_ms bigint, done boolean"
)
RECOVERY_SCHEMA = "run_id string, baseline bigint, recovery_s bigint, recovery_timeout boolean"
EMPTY = (None, None, None, None, None, None, None, False)


def earliest_two(readings: list[tuple[int, int]]) -> tuple[int | None, ...]:
    """The earliest of ``(tick, value)`` readings and the earliest with another value.

    Whatever the baseline turns out to be, its first change is one of the two.
    """
    ordered = sorted(readings)
    if not ordered:
        return None, None, None, None
    tick, value = ordered[0]
    other = next((r for r in ordered if r[1] != value), (None, None))
    return value, tick, other[1], other[0]


class RecoveryProcessor(StatefulProcessor):
    """Per run: baseline, two readings and the timers of its answer and its end.

    The answer's timer is set to the time of the earliest change, or to the limit.  It fires when
    the watermark has passed, so an earlier change that arrives late replaces it before.  The
    state is kept until the limit, so that later readings do not open the run again.
    """

    def __init__(self, limit_s: int):
        self.limit_ms = limit_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.run.get() if self.run.exists() else EMPTY
        baseline, value_1, tick_1, value_2, tick_2, due, end, done = state
        held = [(t, v) for t, v in ((tick_1, value_1), (tick_2, value_2)) if t is not None]
        for part in rows:
            for row in part.itertuples(index=False):
                if pd.notna(row.baseline):
                    baseline = int(row.baseline)
                elif pd.notna(row.value):
                    held.append((int(row.tick_s), int(row.value)))
                end = int(row.reconnect_ms) + self.limit_ms
            held = self._distinct(held)
        value_1, tick_1, value_2, tick_2 = earliest_two(held)
        if not done:
            tick = self._answer(baseline, value_1, tick_1, tick_2)
            new = end if tick is None else end - self.limit_ms + tick * 1000
            if due is not None and due != new and due != end:
                self.handle.deleteTimer(due)
            due = new
            self.handle.registerTimer(due)
            self.handle.registerTimer(end)
        self.run.update((baseline, value_1, tick_1, value_2, tick_2, due, end, done))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.run.exists():
            return
        baseline, value_1, tick_1, value_2, tick_2, due, end, done = self.run.get()
        now = expiredTimerInfo.getExpiryTimeInMs()
        if not done and baseline is not None and now >= due:
            tick = self._answer(baseline, value_1, tick_1, tick_2)
            answer = {"run_id": [key[0]], "baseline": [baseline]}
            answer["recovery_s"] = pd.array([tick], dtype="Int64")
            answer["recovery_timeout"] = [tick is None]
            yield pd.DataFrame(answer)
            done = True
        if now >= end:
            self.run.clear()
        else:
            self.run.update((baseline, value_1, tick_1, value_2, tick_2, due, end, done))

    @staticmethod
    def _distinct(held: list[tuple[int, int]]) -> list[tuple[int, int]]:
        value_1, tick_1, value_2, tick_2 = earliest_two(held)
        return [(t, v) for t, v in ((tick_1, value_1), (tick_2, value_2)) if t is not None]

    @staticmethod
    def _answer(baseline, value_1, tick_1, tick_2) -> int | None:
        if baseline is None:
            return None
        return tick_2 if value_1 == baseline else tick_1


def recovery_stream(
    polls: DataFrame, baselines: DataFrame, limit_s: int = RECOVERY_LIMIT_S, delay: str = "0 seconds"
) -> DataFrame:
    """``operators.latency.recovery_time`` of two streams, started inside ``keyed_state``.

    Both have ``at``: a baseline's is the time of the reconnect, a poll's is ``tick_s`` seconds
    later.  A run is emitted when its first change is certain, or at the limit by its timer
    alone.  Rows without a run are left out.
    """
    at_ms = F.unix_millis("at")
    read = polls.where(F.col("tick_s").between(1, limit_s) & F.col("value").isNotNull()).select(
        "run_id",
        "at",
        (at_ms - F.col("tick_s") * 1000).alias("reconnect_ms"),
        F.lit(None).cast("bigint").alias("baseline"),
        F.col("tick_s").cast("bigint").alias("tick_s"),
        F.col("value").cast("bigint").alias("value"),
    )
    known = baselines.select(
        "run_id",
        "at",
        at_ms.alias("reconnect_ms"),
        F.col("baseline").cast("bigint").alias("baseline"),
        F.lit(None).cast("bigint").alias("tick_s"),
        F.lit(None).cast("bigint").alias("value"),
    )
    rows = known.unionByName(read).where("run_id is not null")
    return (
        rows.withWatermark("at", delay)
        .groupBy("run_id")
        .transformWithStateInPandas(
            statefulProcessor=RecoveryProcessor(limit_s),
            outputStructType=RECOVERY_SCHEMA,
            outputMode="Append",
            timeMode="eventTime",
        )
    )


def keyed_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Start a query with the state store that keyed state and timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    return with_setting(spark, name, provider)


@contextmanager
def short_state(spark: SparkSession) -> Iterator[None]:
    """Start a query whose state is small between micro-batches.

    Every micro-batch commits some six state stores a partition, however few rows they hold, so
    there are at most two partitions a core.  Of the state kept in memory only the latest
    version is.
    """
    partitions = "spark.sql.shuffle.partitions"
    most = min(int(spark.conf.get(partitions)), 2 * spark.sparkContext.defaultParallelism)
    with (
        with_setting(spark, partitions, str(most)),
        with_setting(spark, "spark.sql.streaming.maxBatchesToRetainInMemory", "1"),
    ):
        yield
