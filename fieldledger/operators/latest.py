"""Newest row per key.

Written as aggregates, not as windows: every map task reduces a key to one
row before the shuffle, so a key holding a third of the table costs one row
per task instead of one huge sorted partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """The last row per key in ``order``; NULLs sort lowest. End with a unique column."""
    columns = columns or [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(row, rank).alias("_row")).select(
        *keys, *[F.col(f"_row.`{c}`").alias(c) for c in columns]
    )


def newest_where(condition: Column, value: Column, order: list[Column]) -> Column:
    """Aggregate: ``value`` of the last row that meets ``condition``."""
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return F.max_by(value, F.when(condition, rank))
