"""Size-or-interval flush batches and their statistics."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fleetstream.operators.lookup import Index
from fleetstream.operators.scan import Running, row_rank, running

BATCH_SIZE = 500
TICK_MS = 200
LAG_HISTORY = 1000
# Consecutive batches windowed by one task; a block also reads the tail of the one before.
BLOCK = 8192


def ticked(events: DataFrame, tick_ms: int, t0_ms: int | None) -> DataFrame:
    start = F.lit(t0_ms) if t0_ms is not None else events.agg(F.min("arrival_ms")).scalar()
    started = events.withColumn("tick_start_ms", start.cast("bigint"))
    return started.withColumn("tick", F.expr(f"(arrival_ms - tick_start_ms) div {int(tick_ms)}L"))


def assign_flush_batches(
    events: DataFrame,
    *,
    tick_ms: int = TICK_MS,
    batch_size: int = BATCH_SIZE,
    t0_ms: int | None = None,
) -> DataFrame:
    """Events with ``tick`` and ``batch_in_tick``, assuming writes take no time.

    The buffer is flushed on a fixed tick and whenever it holds ``batch_size`` events;
    a size flush does not move the tick.  ``seq`` orders the events: an integer, or the
    struct that ``with_arrival`` makes.  Ticks start at
    ``t0_ms``, by default the first arrival.
    """
    ranked = row_rank(ticked(events, tick_ms, t0_ms), "seq", ["tick"], "rank_in_tick")
    return ranked.withColumn(
        "batch_in_tick", F.expr(f"rank_in_tick div {int(batch_size)}L")
    ).drop("rank_in_tick")


def flush_batches(
    events: DataFrame,
    *,
    tick_ms: int = TICK_MS,
    batch_size: int = BATCH_SIZE,
    t0_ms: int | None = None,
) -> DataFrame:
    """One row per batch: ``batch_seq``, size, flush time and lag of its last event."""
    # Batches before a tick follow from the event counts per tick alone.
    per_tick = (
        ticked(events, tick_ms, t0_ms)
        .groupBy("tick")
        .agg(F.ceil(F.count(F.lit(1)) / batch_size).cast("bigint").alias("batches"))
    )
    ticks = Index.of(per_tick, "tick", "batches")
    earlier = Running("earlier", "sum", "batches")
    numbered = running(ticks.df, "tick", [earlier])
    starts = ticks.replaced(numbered.withColumn("earlier", F.coalesce("earlier", F.lit(0))))

    assigned = assign_flush_batches(
        events, tick_ms=tick_ms, batch_size=batch_size, t0_ms=t0_ms
    )
    batches = assigned.groupBy("tick", "batch_in_tick").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("arrival_ms").alias("first_arrival_ms"),
        F.max("arrival_ms").alias("last_arrival_ms"),
        F.max_by("t_emit", "seq").alias("last_t_emit"),
        F.min("tick_start_ms").alias("tick_start_ms"),
    )
    tick_end = F.col("tick_start_ms") + (F.col("tick") + 1) * tick_ms
    flushed = F.when(F.col("size") >= batch_size, F.col("last_arrival_ms")).otherwise(tick_end)
    return (
        starts.join(batches.withColumn("flush_ms", flushed), ["earlier"])
        .select(
            (F.col("earlier") + F.col("batch_in_tick")).alias("batch_seq"),
            "tick",
            "batch_in_tick",
            "size",
            "first_arrival_ms",
            "last_arrival_ms",
            "flush_ms",
            (F.col("flush_ms") - F.col("last_t_emit")).alias("lag_ms"),
        )
    )


def rolling_percentile(
    batches: DataFrame,
    value: str = "lag_ms",
    *,
    order: str = "batch_seq",
    group: Sequence[str] = (),
    rows: int = LAG_HISTORY,
    p: float = 0.95,
    name: str = "p95_lag_ms",
    block: int = BLOCK,
) -> DataFrame:
    """Index-form percentile over each batch and the ``rows - 1`` batches before it.

    ``order`` must number the batches of a group without gaps.  Batches are cut into
    blocks and each block also receives the tail it looks back on, so one run with very
    many batches is spread over many tasks.  A task slides over its blocks: a batch puts
    its value into the ordered history and takes out the one that leaves it.  Rows without a
    value take a place in the history and have no part in the percentile.
    """
    if block < rows:
        raise ValueError("block must be at least as long as the history")
    own = F.expr(f"`{order}` div {int(block)}L")
    is_tail = F.col(order) % block >= block - (rows - 1)
    blocks = F.when(is_tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = batches.withColumn("__block", F.explode(blocks)).withColumn("__own", F.col("__block") == own)
    keys = [*group, "__block"]
    dealt = spread.repartition(*keys).sortWithinPartitions(*keys, order)
    schema = StructType([*batches.schema.fields, StructField(name, batches.schema[value].dataType)])
    return dealt.mapInArrow(_slide(keys, value, rows, p, name), schema)


def _slide(
    keys: Sequence[str], value: str, rows: int, p: float, name: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def slide(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, history = None, History(rows, p)
        for batch in incoming:
            found = []
            columns = (batch.column(c).to_pylist() for c in (*keys, value))
            for *k, v in zip(*columns, strict=True):
                if k != key:
                    key, history = k, History(rows, p)
                found.append(history.pushed(v))
            kept = batch.append_column(name, pa.array(found, batch.schema.field(value).type))
            yield kept.filter(batch.column("__own")).drop_columns(["__block", "__own"])

    return slide


class History:
    """The last values in order of arrival and in order of size."""

    def __init__(self, rows: int, p: float):
        self.rows, self.p = rows, p
        self.arrived: deque = deque()
        self.ordered: list = []
        # Not a number is larger than every number.
        self.beyond = 0

    def pushed(self, value):
        """The percentile after one more value."""
        self.arrived.append(value)
        if value is not None:
            if value == value:
                insort(self.ordered, value)
            else:
                self.beyond += 1
        if len(self.arrived) > self.rows:
            gone = self.arrived.popleft()
            if gone is not None:
                if gone == gone:
                    del self.ordered[bisect_left(self.ordered, gone)]
                else:
                    self.beyond -= 1
        n = len(self.ordered) + self.beyond
        if not n:
            return None
        at = min(math.floor(n * self.p), n - 1)
        return self.ordered[at] if at < len(self.ordered) else math.nan
