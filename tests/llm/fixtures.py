"""Small tables for the corpus operators: the given ones and one of awkward rows."""

from __future__ import annotations

import duckdb

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def given(name: str, data: str = DATA) -> list[tuple]:
    return duckdb.connect().execute(f"select * from '{data}/{name}.parquet'").fetchall()


def awkward(spark):
    """Null, empty, blank, symbol-only, short, very long, repeated and tied rows, null columns."""
    base = given("documents")[:12]
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [
        *base,
        base[3],  # the same row again
        (9001, base[4][1], "xx", None, 5),  # the same text in another document
        (9002, None, None, None, None),
        (9003, "", "en", "", 0),
        (9004, " \t\n\x0b\x0c\r ", "en", "src1", 7),
        (9005, "*** 12 --- !!", "en", "src1", 13),
        (9006, "word", "en", "src1", 4),
        (9007, "a b " * 40_000, "en", "src2", 160_000),
        (9008, "start one " + passage + " tail one", "en", "src2", 1),
        (9009, "start two " + passage + " tail two", "en", None, 1),
        (9010, passage + " " + passage, "en", None, 1),
        (9011, "Été \U0001f600 naïve café " * 30, "fr", "src\U0001f600", 1),
        (None, "no id here", "en", "src1", 10),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """Extra columns with names that the operators use inside or give out."""
    from pyspark.sql import functions as F

    extra = "fp rep key cell side range tail h at n edge anchor size target taken rank slices keep node component_id score".split()
    return df.select("*", *[F.lit(f"x {c}").alias(c) for c in extra])


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def ordered(found: list[tuple]) -> list[tuple]:
    return sorted(found, key=lambda r: tuple((x is not None, x) for x in r))
