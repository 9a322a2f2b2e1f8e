"""Stored tables: Parquet folders partitioned by the key, changed by Spark's dynamic partition overwrite.

A load rewrites the partitions that its changes fall into. Putting the same changes in twice gives the same rows,
so a micro-batch that ran but was not recorded is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldledger import schema
from fieldledger.operators import merge

BUCKET = "bucket"


class TableStore:
    """``layouts`` adds tables beside the fixed ones: name -> (schema, key column).

    ``buckets`` hash partitions serve any key. Where keys are handed out in ascending order, ``bucket_rows`` cuts
    the key range instead: changes mostly concern recent keys, so a load rewrites a few partitions of a known size however large
    the table has grown. Text keys are always hashed. A table keeps the numbers that it was made with.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, layouts: dict | None = None, bucket_rows: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets, self.bucket_rows = buckets, bucket_rows
        self.layouts = layouts or {}

    def layout(self, table: str) -> tuple[T.StructType, str]:
        return self.layouts.get(table) or (schema.table_schema(table), schema.key_column(table))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def exists(self, table: str) -> bool:
        files, folder = self._folder(self.path(table))
        return files.exists(folder)

    def bucket_of(self, layout: T.StructType, key: str) -> Column:
        if self.bucket_rows and isinstance(layout[key].dataType, T.LongType):
            rows = F.lit(self.bucket_rows)
            return F.call_function("div", F.col(key) - F.pmod(F.col(key), rows), rows)
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("bigint")

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """Rows of a table, optionally of some partitions only; none if it was never written."""
        layout, _ = self.layout(table)
        if not self.exists(table):
            return self.spark.createDataFrame([], layout)
        rows = self.spark.read.schema(T.StructType([*layout.fields, T.StructField(BUCKET, T.LongType())])).parquet(self.path(table))
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def count(self, table: str) -> int:
        """Rows, -1 for a table that does not exist."""
        return self.read(table).count() if self.exists(table) else -1

    def upsert(self, table: str, changes: DataFrame, newer_by: str | None = None, cheap: bool = False) -> int:
        """Put changes (unique by key) into the table; how many keys were new. ``cheap`` changes are not written aside first."""
        layout, key = self.layout(table)
        changes = schema.fit(changes, layout)
        if not self.exists(table):
            return self._counted(table, changes, "static")
        if cheap:
            return self._merge(table, changes, layout, key, newer_by)
        with self.staged(changes) as once:
            return self._merge(table, once, layout, key, newer_by)

    def _merge(self, table: str, changes: DataFrame, layout: T.StructType, key: str, newer_by: str | None) -> int:
        # one value per partition that changes: a fixed number of hashes, or one for ``bucket_rows`` keys
        touched = [r[0] for r in changes.select(self.bucket_of(layout, key)).distinct().collect()]
        if not touched:
            return 0
        current = self.read(table, touched)
        held = current.count()  # of Parquet footers
        return self._counted(table, merge.upsert(current, changes, key, newer_by), "dynamic") - held

    def _counted(self, table: str, rows: DataFrame, mode: str) -> int:
        seen = Observation()
        self._write(table, rows.observe(seen, F.count(F.lit(1)).alias("rows")), mode)
        return observed(seen).get("rows", 0)

    def replace(self, table: str, rows: DataFrame) -> None:
        """The table holds exactly these rows from now on; they may come from the table itself."""
        layout, _ = self.layout(table)
        with self.staged(schema.fit(rows, layout)) as apart:
            self._write(table, apart, "static")

    def clear(self, table: str) -> None:
        layout, _ = self.layout(table)
        self._write(table, self.spark.createDataFrame([], layout), "static")

    def _write(self, table: str, rows: DataFrame, mode: str) -> None:
        layout, key = self.layout(table)
        # rebalancing by partition lets AQE cut a large one into several files
        cut = rows.withColumn(BUCKET, self.bucket_of(layout, key)).hint("rebalance", F.col(BUCKET))
        cut.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", mode).parquet(self.path(table))

    # Beside the keyed tables ------------------------------------------------

    def put_part(self, name: str, rows: DataFrame, *parts: str) -> None:
        """Rows of a table without key; those of the same partition values are replaced, so a replay changes nothing."""
        rows.write.partitionBy(*parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(name))

    def parts(self, name: str, layout: str) -> DataFrame:
        if not self.exists(name):
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(self.path(name))

    def staged(self, rows: DataFrame) -> Staged:
        return Staged(self, rows)


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A session setting for as long as the block lasts, unless the session has its own."""
    free = spark.conf.get(name, None) is None
    if free:
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if free:
            spark.conf.unset(name)


def observed(seen: Observation) -> dict:
    """Metrics of a write; none if Spark found before running that there are no rows and left the counting out."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


class Staged:
    """``rows`` written beside the tables for as long as a ``with`` block lasts: read often, computed once."""

    def __init__(self, store: TableStore, rows: DataFrame):
        self.store, self.rows = store, rows
        self.path = f"{store.root}/_staging/{uuid.uuid4().hex}"

    def __enter__(self) -> DataFrame:
        self.rows.write.parquet(self.path)
        return self.store.spark.read.schema(self.rows.schema).parquet(self.path)

    def __exit__(self, *_) -> None:
        files, folder = self.store._folder(self.path)
        files.delete(folder, True)
