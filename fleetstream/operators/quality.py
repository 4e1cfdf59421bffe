"""Duplicate and delivery checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_KEY = ("device_id", "frameIdentifier", "t_emit")
STAGES = ("expected", "emitted", "dropped", "received", "persisted", "analysed")


def key_counts(events: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    return events.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_summary(events: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Total rows, distinct keys and the difference, in one row."""
    return key_counts(events, key).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )


def approx_distinct(events: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Opt-in approximate form of the distinct count, without a shuffle of the keys."""
    return events.agg(F.approx_count_distinct(F.struct(*key)).alias("distinct"))


def duplicate_keys(
    events: DataFrame, key: Sequence[str] = EVENT_KEY, n: int | None = None
) -> DataFrame:
    """Keys seen more than once, in key order; the first ``n`` of them if given."""
    found = key_counts(events, key).where(F.col("copies") > 1)
    return found.orderBy(*key).limit(n) if n is not None else found


def distinct_keys(events: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    return events.select(*key).distinct()


def key_head_tail(
    events: DataFrame, key: str, head: int = 10, tail: int = 10, order: str | None = None
) -> DataFrame:
    """The first ``head`` and last ``tail`` values of a key, as a report of both ends.

    In key order, or in that of the column ``order``, such as the arrival.
    """
    by = F.col(order or key)
    first = events.orderBy(by.asc()).limit(head).select(key)
    last = events.orderBy(by.desc()).limit(tail).select(key)
    return first.withColumn("part", F.lit("first")).unionByName(
        last.withColumn("part", F.lit("last"))
    )


def stage_counts(
    stages: Mapping[str, DataFrame],
    observed: DataFrame | None = None,
    *,
    run: str = "run_id",
    key: Sequence[str] = EVENT_KEY,
) -> DataFrame:
    """Rows per run and stage, and total, distinct and repeated keys of what was observed.

    Null where a stage saw nothing of a run.  The observed rows are counted by key first,
    so a key that is delivered again and again is one row by the time the stages meet; all
    stages then meet in one grouped sum.
    """
    none = F.lit(None).cast("bigint")
    parts = [
        events.select(run, F.lit(stage).alias("stage"), F.lit(1).cast("bigint").alias("n"), none.alias("keys"))
        for stage, events in stages.items()
    ]
    if observed is not None:
        copies = observed.groupBy(run, *key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(copies.select(run, F.lit("observed").alias("stage"), "n", F.lit(1).cast("bigint").alias("keys")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    stage = F.col("stage")
    total = F.sum(F.when(stage == "observed", F.col("n")))
    distinct = F.sum("keys")
    return whole.groupBy(run).agg(
        *(F.sum(F.when(stage == name, F.col("n"))).alias(name) for name in STAGES),
        total.alias("observed_total"),
        distinct.alias("observed"),
        (total - distinct).alias("observed_duplicates"),
    )


def ratio(count: str, base: str = "expected") -> Column:
    return F.round(F.try_divide(F.col(count), F.col(base)), 4)


def delivery_report(counts: DataFrame) -> DataFrame:
    """Stage counts with their ratios to ``expected`` and a verdict on the distinct keys observed.

    A repeated delivery of a key is a duplicate and does not change the verdict.
    """
    observed, expected = F.col("observed"), F.col("expected")
    verdict = (
        F.when(observed.isNull() | (observed == 0), "no observation")
        .when(observed == expected, "delivered once")
        .when(observed == expected * 2, "delivered twice")
        .otherwise("unexpected")
    )
    rated = [stage for stage in STAGES if stage not in ("expected", "dropped")]
    ratios = {f"{stage}_ratio": ratio(stage) for stage in (*rated, "observed")}
    return counts.withColumns(
        ratios | {"observed_per_emitted": ratio("observed", "emitted"), "verdict": verdict}
    )
