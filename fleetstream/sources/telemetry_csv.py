"""Wide telemetry CSV, read by header name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstream.functions.scalars import NUMBER_OR_SPECIAL, multi_value_max, number
from fleetstream.schemas import CSV_FIELDS


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """The text of the wanted columns; a typed CSV schema would bind by position."""
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    missing = [name for name in CSV_FIELDS if name not in raw.columns]
    if missing:
        raise ValueError(f"telemetry CSV lacks columns {missing}")
    return raw.select(*CSV_FIELDS)


def _value(name: str, strict: bool = False) -> tuple[Column, Column]:
    """The typed value of a column, and whether its text cannot be read."""
    cell, kind = F.col(name), CSV_FIELDS[name]
    if kind == "multi":
        value = multi_value_max(cell, strict=strict)
        return value, value.isNull()
    value = number(cell, kind, NUMBER_OR_SPECIAL) if kind == "float" else number(cell, kind)
    bad = cell.isNotNull() & (F.trim(cell) != "") & value.isNull()
    if strict:
        message = F.concat(F.lit(f"{name} is not a number: "), cell)
        value = F.when(bad, F.raise_error(message).cast(kind)).otherwise(value)
    return value, bad


def bad_column() -> Column:
    """The first column of a row whose text cannot be read, or null."""
    return F.coalesce(*(F.when(_value(name)[1], F.lit(name)) for name in CSV_FIELDS))


def read_telemetry_csv(spark: SparkSession, path: str, *, strict: bool = False) -> DataFrame:
    """The nine telemetry columns of a CSV with any column order and any other columns.

    Cells are read as text and cast by name.  Blank numbers become null; float columns also
    take NaN and infinities.  Rows with a cell that is not a number are those of
    ``telemetry_csv_rejects``, or fail the read when ``strict``.  A tyre cell with several
    values becomes their maximum.
    """
    cells = _cells(spark, path)
    readable = cells if strict else cells.where(bad_column().isNull())
    return readable.select(*(_value(name, strict)[0].alias(name) for name in CSV_FIELDS))


def telemetry_csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rows that cannot be read: their cells as text and the first ``bad_column``."""
    return _cells(spark, path).withColumn("bad_column", bad_column()).where("bad_column is not null")
