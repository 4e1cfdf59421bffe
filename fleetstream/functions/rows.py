"""Helpers on whole rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add columns that later expressions share without being evaluated again.

    A plain projection is merged into the expressions above it, which repeats costly
    parsing for every use.  The one-element generator here is not.
    """
    made = F.array(F.struct(*(value.alias(name) for name, value in columns.items())))
    kept = keep if keep is not None else [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(made))


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equally named keys where null equals null; the keys of ``left`` are kept."""
    other = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    equal = [F.col(key).eqNullSafe(F.col(f"__right_{key}")) for key in keys]
    joined = left.join(other, reduce(lambda a, b: a & b, equal), how)
    return joined.drop(*(f"__right_{key}" for key in keys))
