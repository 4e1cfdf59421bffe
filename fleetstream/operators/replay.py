"""Telemetry rows fanned out to virtual devices as events.

Device identity is computed from the device number, so pairing rows with devices is
arithmetic and an explode: no join with a device table and no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetstream.functions.rows import null_safe_join
from fleetstream.functions.scalars import device_id
from fleetstream.operators.lookup import Index
from fleetstream.session import materialise

PILOTS = 20
MAX_GAP_MS = 1000
CRITICAL_EVENTS = 100
# Largest array of device numbers one row is expanded through.
CHUNK = 100_000
# Order values per bucket of a timeline: the rows of a session that one task orders.
BUCKET_BITS = 20
CRITICAL_TEMPERATURE = 1500.0


def pilot_and_replica(number: Column, fleet: Column) -> tuple[Column, Column]:
    """Pilot and replica of device ``number`` (from 0) in a fleet of the given size.

    A fleet below 20 has one device per pilot.  A larger one spreads its replicas over
    the 20 pilots, the first pilots holding one more, numbered pilot by pilot.
    """
    number, fleet = number.cast("bigint"), fleet.cast("bigint")
    share = F.floor(fleet / PILOTS)
    extra = fleet % PILOTS
    in_large = number < extra * (share + 1)
    rest = number - extra * (share + 1)
    pilot = F.when(in_large, F.floor(number / (share + 1))).otherwise(
        extra + F.floor(F.try_divide(rest, share))
    )
    replica = F.when(in_large, number % (share + 1)).otherwise(F.try_mod(rest, share))
    small = fleet < PILOTS
    return (
        F.when(small, number).otherwise(pilot).cast("int"),
        F.when(small, F.lit(0)).otherwise(replica).cast("int"),
    )


def with_device(df: DataFrame, number: Column, fleet: Column) -> DataFrame:
    """Set ``pilot_index``, ``replica`` and ``device_id`` from a device number."""
    pilot, replica = pilot_and_replica(number, fleet)
    return df.withColumns({"pilot_index": pilot, "replica": replica}).withColumn(
        "device_id", device_id(F.col("pilot_index"), F.col("replica"))
    )


def fan_out(df: DataFrame, fleet: Column | int, number: str = "device_number") -> DataFrame:
    """One row per device of each row's fleet; a fleet below one device is an error.

    Fleets are cut into chunks of ``CHUNK`` devices, so that no row becomes a huge array;
    the chunks are spread over the cluster before they are written out.
    """
    if isinstance(fleet, int):
        if fleet < 1:
            raise ValueError("a fleet needs at least one device")
        size = F.lit(fleet)
    else:
        size = fleet
    size = size.cast("bigint")
    checked = F.when(size >= 1, size).otherwise(
        F.raise_error(F.lit("a fleet needs at least one device")).cast("bigint")
    )
    spread = chunked(df, F.lit(0).cast("bigint"), checked - 1, F.lit(1).cast("bigint"), number)
    return with_device(spread, F.col(number), size)


def chunked(df: DataFrame, first: Column, last: Column, step: Column, name: str) -> DataFrame:
    """One row per number from ``first`` to ``last`` by ``step``, in chunks of ``CHUNK``."""
    wide = step * CHUNK
    starts = df.withColumns({"__start": F.explode(F.sequence(first, last, wide)), "__step": step, "__last": last})
    end = F.least(F.col("__start") + (F.col("__step") * (CHUNK - 1)), F.col("__last"))
    return (
        starts.hint("rebalance")
        .withColumn(name, F.explode(F.sequence("__start", end, "__step")))
        .select(*df.columns, name)
    )


def devices(spark: SparkSession, count: int) -> DataFrame:
    """The devices of one fleet."""
    if count < 1:
        raise ValueError("a fleet needs at least one device")
    numbers = spark.range(count).withColumnRenamed("id", "device_number")
    return with_device(numbers, F.col("device_number"), F.lit(count))


def emission_total(rate: int, duration_ms: int) -> int:
    return max(1, int(rate * (duration_ms / 1000.0)))


def cyclic_expand(
    rows: DataFrame,
    *,
    devices: int,
    rate: int,
    duration_ms: int,
    t0_ms: int,
    row_index: str = "row_index",
    count: int | None = None,
) -> DataFrame:
    """Events of a fixed-rate replay: emission ``i`` uses row ``i mod R``, device ``i mod D``.

    ``rows`` are numbered densely from 0 in ``row_index``.  Adds ``emission``, the device
    columns, ``elapsed_ms`` and ``t_emit``.  ``count`` is the number of rows, if known.
    """
    total = emission_total(rate, duration_ms)
    interval_us = 1_000_000 // rate
    count = rows.count() if count is None else count
    if count == 0:
        raise ValueError("no rows to replay")
    # Row r is used in the emissions r, r + R, r + 2R, ...
    first = F.col(row_index).cast("bigint")
    last, step = F.lit(total - 1).cast("bigint"), F.lit(count).cast("bigint")
    expanded = chunked(rows.where(first < total), first, last, step, "emission")
    elapsed = F.expr(f"emission * {interval_us}L div 1000L")
    return with_device(
        expanded, F.col("emission") % devices, F.lit(devices)
    ).withColumns({"elapsed_ms": elapsed, "t_emit": F.lit(t0_ms) + elapsed})


def session_ms(session_time: Column, time_scale: float) -> Column:
    """Session time in ms at replay speed: float32 product, double quotient, truncated."""
    product = session_time.cast("float") * F.lit(1000).cast("float")
    return (product.cast("double") / F.lit(float(time_scale))).cast("bigint")


def replay_timeline(
    rows: DataFrame,
    *,
    session: Sequence[str] = (),
    order: str = "row_index",
    time_scale: float = 1.0,
) -> DataFrame:
    """Rows with ``session_ms``, ``wait_ms`` before them and ``offset_ms`` since start.

    The wait is the positive gap to the row before (to 0 for the first), at most one
    second.
    """
    keys = [*session, "__bucket"]
    timed = rows.withColumn("session_ms", session_ms(F.col("sessionTime"), time_scale)).withColumn(
        "__bucket", F.shiftright(F.col(order).cast("bigint"), BUCKET_BITS)
    )
    ordered = Window.partitionBy(*keys).orderBy(order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    time = F.col("session_ms")

    def gap(earlier: Column) -> Column:
        return F.least(F.greatest(time - earlier, F.lit(0)), F.lit(MAX_GAP_MS))

    # One exchange by session and bucket serves the rows and the totals of the buckets.
    inside = (
        timed.repartition(*keys)
        .withColumn("__prev", F.last(time, ignorenulls=True).over(before))
        .withColumn("__gap", F.when(F.col("__prev").isNotNull(), gap(F.col("__prev"))))
        .withColumn("__sum", F.coalesce(F.sum("__gap").over(upto), F.lit(0)))
    )
    known = F.when(time.isNotNull(), F.col(order))
    totals = inside.groupBy(*keys).agg(
        F.min_by("session_ms", known).alias("session_ms"),
        F.max_by("session_ms", known).alias("__last"),
        F.coalesce(F.sum("__gap"), F.lit(0)).alias("__inner"),
    )
    earlier = Window.partitionBy(*session).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.withColumn("__before", F.coalesce(F.last("__last", ignorenulls=True).over(earlier), F.lit(0)))
        .withColumn("__entry", F.when(time.isNotNull(), gap(F.col("__before"))).otherwise(F.lit(0)))
        .withColumn("__carry", F.coalesce(F.sum(F.col("__entry") + F.col("__inner")).over(earlier), F.lit(0)))
        .select(*keys, "__entry", "__carry")
    )
    # The wait into a bucket belongs to its first row with a time.
    entered = F.coalesce("__prev", time).isNotNull()
    wait = F.coalesce("__gap", F.when(entered, F.col("__entry")), F.lit(0))
    offset = F.col("__carry") + F.when(entered, F.col("__entry")).otherwise(F.lit(0)) + F.col("__sum")
    return null_safe_join(inside, carried, keys).select(
        *rows.columns, "session_ms", wait.alias("wait_ms"), offset.alias("offset_ms")
    )


def until_duration(
    timeline: DataFrame, *, duration_ms: int, session: str, order: str = "row_index"
) -> DataFrame:
    """Rows up to and including the first one ``duration_ms`` after the session's start.

    The start is the first session time that is not negative; a session starting at 0
    has no limit, nor has a duration of 0.
    """
    if duration_ms <= 0:
        return timeline
    time, position = F.col("session_ms"), F.col(order)
    starts = Index.of(
        timeline.groupBy(session).agg(
            F.min_by("session_ms", F.when(time >= 0, position)).alias("__start"),
            F.count(F.lit(1)).alias("__n"),
        ),
        session,
        "__n",
    )
    started = starts.join(timeline, ["__start"])
    reached = (F.col("__start") > 0) & (time - F.col("__start") >= duration_ms)
    ends = Index.of(
        started.groupBy(session).agg(
            F.min(F.when(reached, position)).alias("__end"), F.count(F.lit(1)).alias("__n")
        ),
        session,
        "__n",
    )
    kept = ends.join(timeline, ["__end"])
    return kept.where(F.col("__end").isNull() | (position <= F.col("__end"))).drop("__end")


def device_replay(
    rows: DataFrame,
    *,
    devices: int,
    duration_ms: int,
    t0_ms: int,
    session: str,
    order: str = "row_index",
    time_scale: float = 1.0,
) -> DataFrame:
    """Full replay of each session by every device, one device after the other.

    Adds the device columns, ``elapsed_ms`` since the start of the replay and ``t_emit``.
    """
    # Read by several small aggregations and once per device: ordered a single time.
    timeline = materialise(
        replay_timeline(rows, session=[session], order=order, time_scale=time_scale)
    )
    kept = until_duration(timeline, duration_ms=duration_ms, session=session, order=order)
    lengths = Index.of(
        kept.groupBy(session).agg(
            F.max("offset_ms").alias("__length"), F.count(F.lit(1)).alias("__n")
        ),
        session,
        "__n",
    )
    replayed = fan_out(lengths.join(kept, ["__length"]), devices)
    elapsed = F.col("device_number") * F.col("__length") + F.col("offset_ms")
    return replayed.withColumn("elapsed_ms", elapsed).withColumn(
        "t_emit", F.lit(t0_ms) + F.col("elapsed_ms")
    ).drop("__length")


def overlay_critical(
    events: DataFrame, *, inject_at_ms: int, t0_ms: int, order: str = "emission"
) -> DataFrame:
    """Add critical events before the first emission at or after ``inject_at_ms``.

    They copy that event's row and device with an engine temperature of 1500, emitted one
    millisecond apart.  Adds ``is_critical``.  Without such an emission nothing is added.
    """
    due = events.where(F.col("elapsed_ms") >= inject_at_ms)
    chosen = due.agg(F.min(order)).scalar()
    copies = F.when(
        F.col(order) == chosen, F.sequence(F.lit(-1), F.lit(CRITICAL_EVENTS - 1))
    ).otherwise(F.array(F.lit(-1)))
    spread = events.withColumn("__copy", F.explode(copies))
    critical = F.col("__copy") >= 0
    hot = F.lit(CRITICAL_TEMPERATURE).cast("float")
    return spread.withColumns(
        {
            "is_critical": critical,
            "engineTemperature": F.when(critical, hot).otherwise(F.col("engineTemperature")),
            "t_emit": F.when(critical, F.lit(t0_ms) + F.col("elapsed_ms") + F.col("__copy")).otherwise(
                F.col("t_emit")
            ),
        }
    ).drop("__copy")
