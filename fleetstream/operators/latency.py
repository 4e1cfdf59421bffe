"""Recovery time after a disconnect and latency from injection to alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.functions import loglines
from fleetstream.functions.scalars import clock_epoch_s

RECOVERY_LIMIT_S = 60


def recovery_time(
    polls: DataFrame, baselines: DataFrame, limit_s: int = RECOVERY_LIMIT_S
) -> DataFrame:
    """First poll after the reconnect whose counter left the baseline, per run.

    ``polls`` hold ``run_id``, ``tick_s`` and ``value``; ``baselines`` one ``baseline``
    per run.  Runs without a change in time have a null ``recovery_s`` and
    ``recovery_timeout``.
    """
    # Equal readings collapse before the join, so a run sends few rows through it.
    seen = (
        polls.where(F.col("tick_s").between(1, limit_s) & F.col("value").isNotNull())
        .groupBy("run_id", "value")
        .agg(F.min("tick_s").alias("tick_s"))
    )
    changed = (
        seen.join(baselines, "run_id")
        .where(F.col("value") != F.col("baseline"))
        .groupBy("run_id")
        .agg(F.min("tick_s").alias("recovery_s"))
    )
    return baselines.join(changed, "run_id", "left").select(
        "run_id",
        "baseline",
        "recovery_s",
        F.col("recovery_s").isNull().alias("recovery_timeout"),
    )


def log_marks(lines: DataFrame, critical_max: int, *keep: str) -> DataFrame:
    """Injection and alert lines with what is measured on them, and the columns to ``keep``."""
    value, file = F.col("value"), F.col("file_name")
    # Seconds of day instead of clock text keep the aggregation hash-based.
    clock = clock_epoch_s(F.lit("19700101"), loglines.captured(value, loglines.CLOCK))
    injection = (file == "ingestion.log") & value.contains(loglines.INJECT_MARK)
    first_digits = loglines.captured_long(value, r"ALERT window_start=(\d+)")
    return lines.where(
        injection | ((file == "analytics.log") & value.contains(loglines.ALERT_MARK))
    ).select(
        "run_id",
        "line_no",
        injection.alias("is_injection"),
        F.when(injection, clock).alias("clock"),
        F.when(~injection, first_digits).alias("start"),
        (~injection & value.contains(f"max_engine_temp={critical_max}")).alias("is_critical"),
        *keep,
    )


def first_marks() -> list[Column]:
    """Aggregates of a run's marks: first injection, first critical alert, first alert."""
    position, start = F.col("line_no"), F.col("start")
    return [
        F.min_by("clock", F.when(F.col("is_injection"), position)).alias("clock_s"),
        F.min_by("start", F.when(F.col("is_critical") & start.isNotNull(), position)).alias(
            "critical_start"
        ),
        F.min_by("start", F.when(start.isNotNull(), position)).alias("first_start"),
    ]


def measured_latency(window_ms: int) -> list[Column]:
    """Latency and how it was measured, from a run's start and its first marks."""
    inject_s = clock_epoch_s(F.col("run_date"), F.lit("00:00:00")) + F.col("clock_s")
    main = F.expr(f"(critical_start + {int(window_ms)}L) div 1000L") - inject_s
    fallback = F.expr("first_start div 1000L") - F.col("started_s")
    return [
        F.coalesce(main, fallback).alias("e2e_latency_s"),
        F.when(main.isNotNull(), "inject")
        .when(fallback.isNotNull(), "fallback")
        .otherwise("no alert")
        .alias("measured"),
    ]


def alert_latency(
    lines: DataFrame,
    starts: DataFrame,
    *,
    window_ms: int = 10_000,
    critical_max: int = 1500,
) -> DataFrame:
    """Seconds from the injection log line to the end of the first alert it caused.

    ``lines`` hold ``run_id``, ``file_name``, ``line_no`` and ``value``; ``starts`` hold
    ``run_id``, ``run_date`` (yyyyMMdd) and ``started_s``.  Runs without an injection or a
    critical alert fall back to the first alert's start minus the start of the run.
    """
    found = log_marks(lines, critical_max).groupBy("run_id").agg(*first_marks())
    return starts.join(found, "run_id", "left").select("run_id", *measured_latency(window_ms))
