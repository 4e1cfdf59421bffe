"""Tumbling event-time windows, late events, closing times and alerts.

Input events carry ``t_emit`` (epoch ms), ``engineTemperature`` and
``tyresSurfaceTemperature``.  The operators that depend on arrival also need ``seq``
(unique arrival order) and ``arrival_ms``.

An event is late when an earlier arrival already had a larger window key.  That is
the same as: some larger key made its first arrival before the event did.  So the
late test needs no ordering of the events.  One aggregation yields the first arrival
of every key, a reverse running minimum over that small table yields the moment each
window closes, and every event is compared with the closing moment of its own window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.functions.loglines import alert_line
from fleetstream.functions.scalars import window_key
from fleetstream.operators.lookup import Index
from fleetstream.operators.scan import Running, running
from fleetstream.session import materialise

WINDOW_MS = 10_000
ALERT_THRESHOLD = 50.0
# Upper bounds of the latency histogram in seconds (fixed values).
LATENCY_BOUNDS_S = [0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0]
LONG_MAX_AS_DOUBLE = 9.223372036854775e18

KEY = "window_key"


def keyed(events: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    return events.withColumn(KEY, window_key("t_emit", size_ms))


def window_buffers() -> list[Column]:
    """Mergeable aggregates of one window; values are float32, sums double."""
    engine = F.col("engineTemperature").cast("float").cast("double")
    tyre = F.col("tyresSurfaceTemperature").cast("float").cast("double")
    return [
        F.count(F.lit(1)).alias("count"),
        F.sum(engine).alias("sum_engine"),
        F.sum(tyre).alias("sum_tyre"),
        F.max(F.when(~F.isnan(engine), engine)).alias("top_engine"),
        F.max(F.when(~F.isnan(tyre), tyre)).alias("top_tyre"),
        F.min("t_emit").alias("earliest_t_emit"),
        F.max("t_emit").alias("latest_t_emit"),
    ]


def merged_buffers() -> list[Column]:
    """The same aggregates over partial buffers."""
    return [
        F.sum("count").alias("count"),
        F.sum("sum_engine").alias("sum_engine"),
        F.sum("sum_tyre").alias("sum_tyre"),
        F.max("top_engine").alias("top_engine"),
        F.max("top_tyre").alias("top_tyre"),
        F.min("earliest_t_emit").alias("earliest_t_emit"),
        F.max("latest_t_emit").alias("latest_t_emit"),
    ]


def whole_max(top: Column) -> Column:
    """Maximum truncated to a whole number and never below 0."""
    clamped = F.least(F.greatest(top, F.lit(0.0)), F.lit(LONG_MAX_AS_DOUBLE))
    return clamped.cast("bigint")


def finish_windows(buffers: DataFrame, size_ms: int, extra: Sequence[str] = ()) -> DataFrame:
    """Window rows from complete buffers."""
    return buffers.select(
        (F.col(KEY) * size_ms).alias("window_start"),
        (F.col(KEY) * size_ms + size_ms).alias("window_end"),
        "count",
        (F.col("sum_engine") / F.col("count")).alias("mean_engine_temp"),
        (F.col("sum_tyre") / F.col("count")).alias("mean_tyre_temp"),
        whole_max(F.col("top_engine")).alias("max_engine_temp"),
        whole_max(F.col("top_tyre")).alias("max_tyre_temp"),
        "earliest_t_emit",
        "latest_t_emit",
        *extra,
    )


def windows(events: DataFrame, size_ms: int = WINDOW_MS, *, flush: bool = False) -> DataFrame:
    """Windows of events that arrive in time order.

    A window is closed by any later key, so the last one stays open and is left out
    unless ``flush``.
    """
    buffers = keyed(events, size_ms).groupBy(KEY).agg(*window_buffers())
    if not flush:
        last = events.agg(F.max(window_key("t_emit", size_ms))).scalar()
        buffers = buffers.where(F.col(KEY) < last)
    return finish_windows(buffers, size_ms)


def first_arrivals(events: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Row count and first arrival of every window key."""
    return (
        keyed(events, size_ms)
        .groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("seq").alias("first_seq"),
            F.min_by("arrival_ms", "seq").alias("first_arrival_ms"),
        )
    )


def window_index(events: DataFrame, size_ms: int = WINDOW_MS) -> Index:
    """One row per window key: its first arrival and the arrival that closes it.

    ``close_seq`` and ``closed_at_ms`` are null while no larger key has arrived.  A key
    whose first arrival comes after its closing moment holds late events only.
    """
    return close_index(first_arrivals(events, size_ms))


def close_index(
    firsts: DataFrame, hold: Callable[[DataFrame], DataFrame] = materialise
) -> Index:
    """Add the closing arrival to a table of first arrivals per key."""
    index = Index.of(firsts, KEY, "n", hold)
    arrival = index.df.withColumn("__arrival", F.struct("first_seq", "first_arrival_ms"))
    closing = Running("__close", "min", "__arrival")
    closed = running(arrival, KEY, [closing], reverse=True).select(
        *index.df.columns,
        F.col("__close.first_seq").alias("close_seq"),
        F.col("__close.first_arrival_ms").alias("closed_at_ms"),
    )
    return index.replaced(closed if index.is_small else hold(closed))


def on_time(index: Index) -> Index:
    """Index rows of windows that accept at least one event."""
    accepts = F.col("close_seq").isNull() | (F.col("first_seq") < F.col("close_seq"))
    return index.replaced(index.df.where(accepts))


def mark_late(events: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Events with ``is_late``: whether an earlier arrival had a larger window key."""
    index = window_index(events, size_ms)
    joined = index.join(keyed(events, size_ms), ["close_seq"])
    late = F.coalesce(F.col("seq") > F.col("close_seq"), F.lit(False))
    return joined.withColumn("is_late", late).drop("close_seq")


def accepted_buffers(events: DataFrame, index: Index, size_ms: int) -> DataFrame:
    """Buffers of the events that are not late, with the closing time of their window."""
    joined = on_time(index).join(keyed(events, size_ms), ["close_seq", "closed_at_ms"])
    accepted = joined.where(F.col("close_seq").isNull() | (F.col("seq") < F.col("close_seq")))
    return accepted.groupBy(KEY).agg(
        *window_buffers(), F.min("closed_at_ms").alias("closed_at_ms")
    )


def exact_windows(
    events: DataFrame,
    size_ms: int = WINDOW_MS,
    *,
    flush_at_ms: int | None = None,
) -> DataFrame:
    """Closed windows after dropping late events, with closing time and latency.

    Latency is the closing moment minus the earliest ``t_emit`` of the window.  With
    ``flush_at_ms`` the window still open is emitted too, closed at that time.
    """
    index = window_index(events, size_ms)
    buffers = accepted_buffers(events, index, size_ms)
    if flush_at_ms is None:
        buffers = buffers.where(F.col("closed_at_ms").isNotNull())
    else:
        buffers = buffers.withColumn(
            "closed_at_ms", F.coalesce("closed_at_ms", F.lit(flush_at_ms).cast("bigint"))
        )
    return with_latency(finish_windows(buffers, size_ms, ["closed_at_ms"]))


def with_latency(closed: DataFrame) -> DataFrame:
    latency = F.col("closed_at_ms") - F.col("earliest_t_emit")
    return closed.withColumn("e2e_latency_ms", latency)


def late_counts(events: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Accepted and late events in one row."""
    marked = mark_late(events, size_ms)
    return marked.agg(
        F.count_if(~F.col("is_late")).alias("accepted"),
        F.count_if("is_late").alias("late"),
    )


def alerts(closed: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Windows whose mean engine temperature exceeds the threshold."""
    mean = F.col("mean_engine_temp")
    # Spark orders NaN above every number; a NaN mean is not an alert.
    return closed.where(~F.isnan(mean) & (mean > threshold))


def alert_lines(closed: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Alerts with their log text."""
    return alerts(closed, threshold).withColumn("line", alert_line())


def latest_mean(closed: DataFrame) -> DataFrame:
    """Mean of the most recently closed window."""
    return closed.agg(F.max_by("mean_engine_temp", "window_start").alias("mean_engine_temp"))


def latency_histogram(
    closed: DataFrame, bounds_s: Sequence[float] = tuple(LATENCY_BOUNDS_S)
) -> DataFrame:
    """Cumulative latency histogram: rows ``le``, ``observations``, plus sum and count."""
    seconds = F.col("e2e_latency_ms") / 1000.0
    labels = [*(str(bound) for bound in bounds_s), "+Inf"]
    counted = closed.agg(
        *(F.count_if(seconds <= bound).alias(f"b{i}") for i, bound in enumerate(bounds_s)),
        F.count(seconds).alias(f"b{len(bounds_s)}"),
        (F.coalesce(F.sum("e2e_latency_ms"), F.lit(0)) / 1000.0).alias("sum_s"),
    )
    buckets = F.array(
        *(
            F.struct(F.lit(label).alias("le"), F.col(f"b{i}").alias("observations"))
            for i, label in enumerate(labels)
        )
    )
    return counted.select(
        F.inline(buckets),
        "sum_s",
        F.col(f"b{len(bounds_s)}").alias("count"),
    )
