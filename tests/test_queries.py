"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from conftest import SMALL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    diff = compare(spark, con, QUERIES, ORACLES, name, SMALL)
    assert diff in ("", "(equal, but empty)")


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(ORACLES) <= set(QUERIES)
