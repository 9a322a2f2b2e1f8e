"""All DuckDB statements by query name."""

from __future__ import annotations

from checks.operator_sql import operator_oracles
from checks.reports import report_oracles


def all_oracles() -> dict[str, str]:
    return {**report_oracles(), **operator_oracles()}
