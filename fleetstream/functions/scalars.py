"""Column functions on telemetry values and event fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetstream.schemas import EVENT_FIELDS

# Decimal number text: no type suffixes, which Spark's own cast would accept.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NUMBER_OR_SPECIAL = r"(?i)^[+-]?(nan|infinity|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)$"
# The lowest finite float: a part must exceed it to count.
FLOAT_LOWEST = -3.4028234663852886e38


def number(text: Column, type_name: str = "double", pattern: str = NUMBER) -> Column:
    """``text`` as a number, or null when it is not plain number text."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(pattern), trimmed.try_cast(type_name))


def multi_value_max(text: Column, *, strict: bool = False) -> Column:
    """Largest of the values in a ``84/84/89/89`` cell, as float.

    Blank is 0.  Without a slash the text must be one number: anything else is null,
    or an error when ``strict``.  With slashes unreadable parts are skipped and a cell
    without any readable part is 0.
    """
    single = number(text, "float", NUMBER_OR_SPECIAL)
    if strict:
        message = F.concat(F.lit("not a number: "), text)
        single = F.coalesce(single, F.raise_error(message).cast("float"))
    parts = F.transform(
        F.split(text, "/"), lambda part: number(part, "float", NUMBER_OR_SPECIAL)
    )
    readable = F.filter(
        parts, lambda v: v.isNotNull() & ~F.isnan(v) & (v > F.lit(FLOAT_LOWEST))
    )
    zero = F.lit(0).cast("float")
    return (
        F.when(text.isNull() | (F.trim(text) == ""), zero)
        .when(~text.contains("/"), single)
        .otherwise(F.coalesce(F.array_max(readable), zero))
    )


def device_id(pilot: Column, replica: Column) -> Column:
    return F.concat_ws("-", pilot.cast("string"), replica.cast("string"))


def window_key(t_emit: str, size_ms: int) -> Column:
    """Tumbling window number of an epoch-ms column (integer division)."""
    return F.expr(f"`{t_emit}` div {int(size_ms)}L")


def epoch_ms(ts: Column) -> Column:
    """Whole epoch milliseconds of a timestamp; zone-less timestamps count as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def event_json(columns: Sequence[str] | None = None) -> Column:
    """Event columns as JSON text with the wire field names."""
    return F.to_json(F.struct(*(columns or EVENT_FIELDS)))


def excerpt(payload: Column, length: int = 200) -> Column:
    return F.substring(payload, 1, length)


def percent(text: Column) -> Column:
    """``83.1%`` as 83.1; blank is 0 and other text is null."""
    bare = F.replace(text, F.lit("%"), F.lit(""))
    return F.when(text.isNull() | (bare == ""), F.lit(0.0)).otherwise(number(bare))


# Unit and factor to MB, tried in this order.  The KiB factor is 0.001, not 1/1024:
# published results were computed with it.
MEMORY_UNITS = [("GiB", 1024.0), ("MiB", 1.0), ("KiB", 0.001), ("B", 1e-6)]


def memory_mb(text: Column) -> Column:
    """Used part of ``512.5MiB / 15.5GiB`` in MB; unreadable text is 0."""
    used = F.when(text.contains("/"), F.trim(F.split_part(text, F.lit("/"), F.lit(1)))).otherwise(
        text
    )
    value = F.lit(0.0)
    for unit, factor in reversed(MEMORY_UNITS):
        amount = number(F.replace(used, F.lit(unit), F.lit("")))
        value = F.when(used.contains(unit), F.coalesce(amount * F.lit(factor), F.lit(0.0))).otherwise(
            value
        )
    return value


def mask_password(url: Column) -> Column:
    """Hide the password of the first ``:password@`` in a connection URL."""
    return F.regexp_replace(url, r"^(.*?):[^:@]+@", r"$1:***@")


def clock_epoch_s(run_date: Column, clock: Column) -> Column:
    """Epoch seconds of an ``HH:MM:SS`` log clock on a ``yyyyMMdd`` date (UTC)."""
    text = F.concat_ws(" ", run_date, clock)
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit("yyyyMMdd HH:mm:ss")))


def fixed_text(value: Column, digits: int) -> Column:
    """Number text with fixed decimals, rounded on the exact binary value, ties to even."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def rounded_even(value: Column, digits: int) -> Column:
    """Rounding of report figures: on the exact binary value, ties to even."""
    return fixed_text(value.cast("double"), digits).try_cast("double")


def whole_number_text(value: Column) -> Column:
    """``3.0`` as ``3``, other numbers unchanged, null as ``n/a``."""
    return (
        F.when(value.isNull(), F.lit("n/a"))
        .when(value == F.floor(value), value.cast("bigint").cast("string"))
        .otherwise(value.cast("string"))
    )


def or_na(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("n/a"))
