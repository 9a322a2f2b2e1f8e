"""Keyed upsert: whole rows replace whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.operators.joins import without
from fieldledger.operators.latest import newest


def last_arrivals(batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the last to arrive. Rows without key are left out."""
    return newest(batch.where(F.col(key).isNotNull()), [key], order)


def repeated(batch: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row has."""
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(key)


def last_of_repeated(batch: DataFrame, key: str, order: list[Column], twice: DataFrame) -> DataFrame:
    """The same as ``last_arrivals`` for rows that have a key, where ``twice`` are the keys that come more than once."""
    several = batch.join(twice, key, "left_semi")
    return batch.join(twice, key, "left_anti").unionByName(newest(several, [key], order))


def upsert(current: DataFrame, changes: DataFrame, key: str, newer_by: str | None = None) -> DataFrame:
    """``current`` with the changed rows put in; ``changes`` is unique by key.

    Stored rows are only looked at for "is this key among the changes", so a
    small batch travels to the table and not the table to the batch. With
    ``newer_by`` a change older than the stored row is dropped.
    """
    changes = changes.select(*current.columns)
    if newer_by:
        stored = current.join(changes.select(F.col(key)), key, "left_semi").select(
            F.col(key).alias("_key"), F.col(newer_by).alias("_stored")
        )
        known = changes.join(stored, changes[key] == stored["_key"], "left")
        older = F.col("_stored").isNotNull() & (
            F.col(newer_by).isNull() | (F.col(newer_by) < F.col("_stored"))
        )
        changes = known.where(~older).drop("_key", "_stored")
    return without(current, changes, key, key).unionByName(changes)


def deleted(current: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Stored rows a full snapshot no longer has."""
    return without(current, snapshot, key, key)
