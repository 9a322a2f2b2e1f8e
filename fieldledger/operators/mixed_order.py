"""Sort key of a column that holds integers in some rows and texts in others."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mixed_rank(number: Column, text: Column) -> Column:
    """0 for NULL, 1 for integers, 2 for texts."""
    return F.when(text.isNotNull(), 2).when(number.isNotNull(), 1).otherwise(0)


def mixed_order(number: Column, text: Column) -> list[Column]:
    """NULLs first, then every integer by value, then every text by its characters."""
    return [mixed_rank(number, text), number, text]
