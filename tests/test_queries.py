"""Every registered query against its DuckDB statement on the smallest tables."""

import pytest

from checks.compare import compare, duck
from checks.oracles import all_oracles
from checks.registry import all_queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    outcome = compare(spark, con, name, all_queries()[name], all_oracles().get(name), DATA)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
