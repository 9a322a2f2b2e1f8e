"""Run registered queries against their DuckDB statements and report differences.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import all_oracles
from checks.registry import all_queries
from fieldledger.session import build_session

# DuckDB type expected for a Spark type.
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN", "date": "DATE"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else f"{value:.6f}"
    return "NULL" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, name, query, sql, sf_dir) -> str:
    df = query(spark, sf_dir)
    left, names = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only {len(left)}"
    result = con.execute(sql)
    right_names = [d[0] for d in result.description]
    right_types = {d[0]: str(d[1]) for d in result.description}
    right, duck_names = table(right_names, result.fetchall())
    if names != duck_names:
        return f"DIFFERENT columns {names} / {duck_names}"
    odd = [(c, t, right_types[c]) for c, t in df.dtypes if TYPES.get(t, t) != right_types[c]]
    note = f" types {odd}" if odd else ""
    if len(left) != len(right):
        return f"DIFFERENT rows {len(left)} / {len(right)}{note}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"DIFFERENT values in {len(wrong)} of {len(left)} {names}\n   {wrong[0][0]}\n   {wrong[0][1]}{note}"
    return f"ok {len(left)}{note}"


def main(sf_dir: str, only: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), all_oracles(), 0
    for name, query in all_queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            outcome = compare(spark, con, name, query, sqls.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            outcome = f"DIFFERENT error {str(error)[:500]}"
        bad += outcome.startswith("DIFFERENT") or " types " in outcome
        print(f"{name:40s} {time.time() - start:5.1f}s {outcome}", flush=True)
    print(f"{bad} different")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
