"""Joining a large table to an index of its own keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstream.functions.rows import null_safe_join
from fleetstream.session import materialise

# An index up to this size is broadcast; a row counts its key and ROW_BYTES.
MAX_SMALL_BYTES = 48 << 20
ROW_BYTES = 96
# Beyond it, keys above this share of all rows are joined separately.  At most
# 1 / HOT_SHARE keys can be that large, so broadcasting those is always safe.
HOT_SHARE = 0.001


@dataclass(frozen=True)
class Index:
    """A materialised table with one row per ``key`` (null is a key) and its size in bytes.

    ``count`` names the column holding the number of rows behind each key.
    """

    df: DataFrame
    key: str
    count: str
    size: int
    total: int

    @classmethod
    def of(
        cls, df: DataFrame, key: str, count: str, hold: Callable[[DataFrame], DataFrame] = materialise
    ) -> Index:
        """``hold`` keeps the table between its uses: a checkpoint, or a cache for a short time."""
        table = hold(df)
        key_bytes = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))
        size, total = table.agg(F.sum(key_bytes + ROW_BYTES), F.sum(count)).first()
        return cls(table, key, count, size or 0, total or 0)

    @property
    def is_small(self) -> bool:
        return self.size <= MAX_SMALL_BYTES

    def replaced(self, df: DataFrame) -> Index:
        """The same index with columns added or rows removed."""
        return replace(self, df=df)

    def join(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Inner join that adds ``columns`` to the rows whose key is in the index.

        The index is broadcast only when its counted size allows it.  Otherwise the hot
        keys, whose number is bounded by their share, go through a broadcast join and
        the rest, now free of hot keys, through a shuffle.
        """
        wanted = [self.key, *columns]
        if self.is_small:
            return null_safe_join(rows, F.broadcast(self.df.select(wanted)), [self.key])
        is_hot = F.col(self.count) > F.lit(self.total * HOT_SHARE)
        hot = self.df.where(is_hot).select(wanted)
        cold = self.df.where(~is_hot).select(wanted)
        in_hot = null_safe_join(rows, F.broadcast(hot), [self.key])
        not_hot = null_safe_join(rows, F.broadcast(hot.select(self.key)), [self.key], "left_anti")
        return in_hot.unionByName(null_safe_join(not_hot, cold, [self.key]))
