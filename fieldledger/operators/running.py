"""Running totals and positions over sorted rows, without a window over a whole group.

Rows are dealt out in ranges of their order, so one group (or the whole table) may spread over many tasks.
Each slice is summed up by itself; what lies before a slice is a few numbers for each slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.session import work_dir

SLICE, TIE = "_slice", "_tie"


def in_slices(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``df`` dealt by ranges of group and order and written, with the number of its slice and a last sort key.

    Rows that are equal in every sort key are told apart by ``_tie``, so they spread over slices too.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(width, *group, *order, TIE).withColumn(SLICE, F.spark_partition_id())
    path = work_dir(spark, "slices")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def running(df: DataFrame, group: list[str], order: list[Column], **totals: tuple[str, Column]) -> DataFrame:
    """``df`` with running totals up to and including each row, in ``order`` within ``group`` (columns without nulls).

    ``totals``: name -> (``count``, ``sum`` or ``bit_xor``, column). Without group columns the whole table is one group.
    """
    rows = in_slices(df, group, order)
    merged = {"count": "sum", "sum": "sum", "bit_xor": "bit_xor"}
    ends = rows.groupBy(SLICE, *group).agg(*[getattr(F, kind)(column).alias(f"_{name}") for name, (kind, column) in totals.items()])
    if group:
        before = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        sums = [getattr(F, merged[kind])(f"_{name}").over(before).alias(f"_{name}") for name, (kind, _) in totals.items()]
        # groups that lie in one slice have nothing before: what is left is one row for each further slice of a group
        carried = ends.select(SLICE, *group, *sums, F.count(F.lit(1)).over(before).alias("_n")).where("_n > 0").drop("_n")
    else:
        carried = _carried(ends, totals)
    within = Window.partitionBy(SLICE, *group).orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(carried, [SLICE, *group], "left")
    out = {}
    for name, (kind, column) in totals.items():
        own, past = getattr(F, kind)(column).over(within), F.coalesce(F.col(f"_{name}"), F.lit(0))
        out[name] = own.bitwiseXOR(past) if kind == "bit_xor" else own + past
    return joined.withColumns(out).drop(SLICE, TIE, *[f"_{name}" for name in totals])


def _carried(ends: DataFrame, totals: dict) -> DataFrame:
    """What lies before each slice of the whole table; one row for each slice passes the driver."""
    found = sorted(ends.collect(), key=lambda r: r[SLICE])
    rows, past = [], [0] * len(totals)
    for row in found:
        rows.append((row[SLICE], *past))
        kinds = [kind for kind, _ in totals.values()]
        past = [a ^ (b or 0) if k == "bit_xor" else a + (b or 0) for a, b, k in zip(past, row[1:], kinds, strict=True)]
    return ends.sparkSession.createDataFrame(rows, ends.schema)


def positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 1, in the given order of the whole table."""
    return running(df, [], order, **{name: ("count", F.lit(1))})
