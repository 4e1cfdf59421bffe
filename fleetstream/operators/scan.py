"""Running aggregates over an ordered column without a single-task window.

A plain ``Window.orderBy`` without partition columns, or with one hot partition
value, sorts everything in one task.  Here the integer order column is cut into
buckets of ``2**bits`` values: rows are windowed inside (group, bucket), bucket
totals are scanned the same way one level up, and each row adds the total carried
into its bucket.  With a unique order column a task never holds more than
``2**bits`` rows of one group; two levels of 20 bits leave at most ``2**23``
bucket totals for the top window of any 64-bit range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstream.functions.rows import null_safe_join


@dataclass(frozen=True)
class Running:
    """Aggregate of ``value`` over the rows strictly before (or after) each row.

    ``kind`` is ``sum``, ``max``, ``min`` or ``last`` (value of the nearest row).
    """

    name: str
    kind: str
    value: str

    def over(self, window) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        return getattr(F, self.kind)(self.value).over(window)

    def total(self, order: str, reverse: bool) -> Column:
        if self.kind == "last":
            nearest = F.min_by if reverse else F.max_by
            return nearest(self.value, order)
        return getattr(F, self.kind)(self.value)

    def merge(self, local: Column, carried: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(local + carried, local, carried)
        if self.kind == "max":
            return F.greatest(local, carried)
        if self.kind == "min":
            return F.least(local, carried)
        return F.coalesce(local, carried)


def running(
    df: DataFrame,
    order: str,
    measures: Sequence[Running],
    group: Sequence[str] = (),
    *,
    reverse: bool = False,
    bits: int = 20,
    levels: int = 2,
) -> DataFrame:
    """Add each measure, aggregated over the group's rows with a smaller ``order``.

    ``reverse`` looks at larger order values instead.  ``order`` must be unique within the
    group: an integer, or a struct whose first field is an integer, by which rows are then
    bucketed.  A null group is a group like any other.  A row with nothing before it gets
    null.
    """
    group = list(group)
    direction = F.col(order).desc() if reverse else F.col(order).asc()

    def before(*keys: str):
        return (
            Window.partitionBy(*keys)
            .orderBy(direction)
            .rowsBetween(Window.unboundedPreceding, -1)
        )

    if levels == 0:
        return df.withColumns({m.name: m.over(before(*group)) for m in measures})

    bucket = f"__bucket{levels}"
    kind = df.schema[order].dataType
    leading = F.col(order)[kind[0].name] if isinstance(kind, T.StructType) else F.col(order)
    bucketed = df.withColumn(bucket, F.shiftright(leading.cast("bigint"), bits))
    totals = bucketed.groupBy(*group, bucket).agg(
        *(m.total(order, reverse).alias(f"__total_{m.name}") for m in measures)
    )
    carried = running(
        totals,
        bucket,
        [Running(f"__carry_{m.name}", m.kind, f"__total_{m.name}") for m in measures],
        group,
        reverse=reverse,
        bits=bits,
        levels=levels - 1,
    ).drop(*(f"__total_{m.name}" for m in measures))

    local = bucketed.withColumns(
        {f"__local_{m.name}": m.over(before(*group, bucket)) for m in measures}
    )
    joined = null_safe_join(local, carried, [*group, bucket], "left")
    merged = joined.withColumns(
        {
            m.name: m.merge(F.col(f"__local_{m.name}"), F.col(f"__carry_{m.name}"))
            for m in measures
        }
    )
    return merged.select(*df.columns, *(m.name for m in measures))


def row_rank(
    df: DataFrame, order: str, group: Sequence[str] = (), name: str = "row_rank", **options
) -> DataFrame:
    """Zero-based position of each row in its group by ``order``."""
    counted = running(
        df.withColumn("__one", F.lit(1).cast("bigint")),
        order,
        [Running(name, "sum", "__one")],
        group,
        **options,
    )
    return counted.drop("__one").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
