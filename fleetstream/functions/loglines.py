"""Fields of run-log lines, and the alert line itself.

The texts matched here are fixed formats written by the services under test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetstream.functions.scalars import NUMBER, fixed_text

# Log texts and the run-id grammar.
ALERT_MARK = "ALERT window_start="
INJECT_MARK = "INJECT_HIGH_TEMP"
EMITTED_DROPPED = r"emitted=(\d+)\s+dropped=(\d+)"
EMITTED_AT_END = r"mode završen:\s+emitted=(\d+)"
# Anchored: an open start would retry the leading part at every position.
MEAN_ENGINE = r"^.*mean_engine_temp=([\d.]+)"
RECOVERED = r"Recovery detected at \+(\d+)s"
NO_RECOVERY = "No recovery within 60s"
E2E_SECONDS = r"E2E latency \([^)]+\):\s+(-?\d+)s"
CLOCK = r"^\[([0-9:]+) [^\]]+\]"
RUN_ID = r"^scenario-([A-D])-(mqtt|kafka)(?:-(\d{8}-\d{6}))?(?:-(\d+))?(?:-([a-zA-Z0-9]+))?"

# The alert text and its fields in order.
ALERT_FORMAT = (
    "ALERT window_start=%d window_end=%d count=%d mean_engine_temp=%s mean_tyre_temp=%s "
    "max_engine_temp=%d max_tyre_temp=%d e2e_latency_ms=%d"
)
ALERT_FIELDS = [
    "window_start",
    "window_end",
    "count",
    "mean_engine_temp",
    "mean_tyre_temp",
    "max_engine_temp",
    "max_tyre_temp",
    "e2e_latency_ms",
]


def captured(line: Column, pattern: str, group: int = 1) -> Column:
    """Captured text, or null when the line does not match."""
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))


def captured_long(line: Column, pattern: str, group: int = 1) -> Column:
    """Captured digits as a number; null when the line does not match."""
    return captured_number(line, pattern, group, "bigint")


def captured_number(
    line: Column, pattern: str, group: int = 1, type_name: str = "double"
) -> Column:
    # Casting the empty text of a line without a match would raise and catch an exception
    # for every such row, so only captured text reaches the cast.
    return captured(line, pattern, group).try_cast(type_name)


def counter_line(line: Column, name: str) -> Column:
    """N of a line that starts with ``name`` and continues ``... = N``."""
    return captured_long(line, rf"^{name}[^=]*=\s*(\d+)")


def alert_line() -> Column:
    """Alert text of a window row."""
    texts = [
        fixed_text(F.col(name), 2) if name.startswith("mean") else F.col(name)
        for name in ALERT_FIELDS
    ]
    return F.format_string(ALERT_FORMAT, *texts)


def alert_field(line: Column, name: str) -> Column:
    """One field of an alert line, null for other lines."""
    return F.when(line.contains(ALERT_MARK), captured(line, rf"\b{name}=(-?[\d.]+)"))


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\n\x0b\x0c"))


def metric_name(line: Column) -> Column:
    """Name part (labels included) of a metric dump line, split at the last space."""
    text = stripped(line)
    rest = F.length(text) - F.length(F.substring_index(text, " ", -1)) - 1
    return F.when(~text.startswith("#") & (rest > 0), F.left(text, rest))


def metric_value(line: Column) -> Column:
    """Value part of a metric dump line; null for anything but a number."""
    text = F.substring_index(stripped(line), " ", -1)
    special = F.lower(text).isin("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
    return F.when(text.rlike(NUMBER) | special, text.try_cast("double"))


def run_id_part(run_id: Column, part: str) -> Column:
    groups = {"scenario": 1, "broker": 2, "started": 3, "num_devices": 4, "level": 5}
    return captured(run_id, RUN_ID, groups[part])


def normalise_level(broker: Column, raw: Column) -> Column:
    """Delivery level of a broker in canonical form; null when not valid for it.

    Blank means "not given" and stays blank.
    """
    # The names of the levels.
    level = F.lower(raw)
    mqtt = broker == "mqtt"
    kafka = broker == "kafka"
    return (
        F.when(level == "", "")
        .when((mqtt | kafka) & level.isin("qos0", "acks0", "0"), "0")
        .when((mqtt | kafka) & level.isin("qos1", "acks1", "1"), "1")
        .when(mqtt & level.isin("qos2", "2"), "2")
        .when(kafka & level.isin("acksall", "all"), "all")
    )
