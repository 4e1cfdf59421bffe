"""Exact order statistics without collecting a group."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstream.functions.rows import null_safe_join
from fleetstream.operators.scan import Running, running

# Values per bucket: the most distinct values one task ever orders for one group.
BUCKET_BITS = 16


def index_percentile(
    df: DataFrame,
    value: str,
    group: Sequence[str] = (),
    p: float = 0.95,
    *,
    name: str = "percentile",
    extra: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """``sorted[min(floor(n * p), n - 1)]`` of an integer column per group.

    Equal values are counted before the shuffle.  Bucket counts then locate the bucket
    that holds the wanted rank, and only that bucket's distinct values are ordered.
    ``extra`` adds aggregates written over (distinct value, its count).  Null values are left
    out; a null group is a group like any other.
    """
    group = list(group)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("bigint").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__b", F.shiftright("__v", BUCKET_BITS))
    )
    extra = extra or {}
    buckets = counts.groupBy(*group, "__b").agg(F.sum("__n").alias("__bn"))
    # Levels of 24 bits over 48-bit bucket numbers: no task scans more than 2**24 totals.
    before = running(
        buckets, "__b", [Running("__before", "sum", "__bn")], group, bits=24, levels=1
    ).withColumn("__before", F.coalesce("__before", F.lit(0)))
    totals = buckets.groupBy(*group).agg(F.sum("__bn").alias("__total"))
    rank = F.least(F.floor(F.col("__total") * F.lit(p)), F.col("__total") - 1)
    ranked = totals.select(*group, rank.alias("__rank"))
    if group:
        placed = null_safe_join(before, ranked, group)
    else:
        placed = before.withColumn("__rank", ranked.scalar())
    located = placed.where(
        (F.col("__rank") >= F.col("__before"))
        & (F.col("__rank") < F.col("__before") + F.col("__bn"))
    ).select(*group, "__b", (F.col("__rank") - F.col("__before")).alias("__rest"))
    in_bucket = (
        Window.partitionBy(*group, "__b")
        .orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # A grouped result has no empty groups; without groups an empty input gives 0.
    lowest = F.min("__v") if group else F.coalesce(F.min("__v"), F.lit(0))
    picked = (
        null_safe_join(counts, located, [*group, "__b"])
        .withColumn("__seen", F.sum("__n").over(in_bucket))
        .where(F.col("__seen") > F.col("__rest"))
        .groupBy(*group)
        .agg(lowest.alias(name))
    )
    if not extra:
        return picked
    v, n = F.col("__v"), F.col("__n")
    summary = counts.groupBy(*group).agg(*(f(v, n).alias(alias) for alias, f in extra.items()))
    if group:
        return null_safe_join(summary, picked, group)
    # One row each: attach the percentile as a scalar.
    return summary.withColumn(name, picked.scalar())
