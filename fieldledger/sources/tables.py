"""Named tables the reports read."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldledger import schema


class Tables(Mapping):
    """Lazy name -> DataFrame mapping; a table is opened when first asked for."""

    def __init__(self, openers: Mapping):
        self._openers = dict(openers)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            found = self._openers[name]
            self._open[name] = found() if callable(found) else found
        return self._open[name]

    def with_table(self, name: str, rows: DataFrame) -> Tables:
        """The same tables with one put in or replaced; nothing is opened."""
        return Tables({**self._openers, name: rows})

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)


def parquet_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> Tables:
    """Tables stored as ``root/<table>``, read with their fixed layouts."""

    def opener(name: str):
        return lambda: spark.read.schema(schema.table_schema(name)).parquet(f"{root}/{name}")

    return Tables({n: opener(n) for n in names or schema.TABLE_COLUMNS})


def row_count(tables: Mapping, name: str) -> int:
    """Rows of a table, -1 when there is no such table."""
    return tables[name].count() if name in tables else -1
