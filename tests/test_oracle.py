"""Every registered query against its SQL."""

import pytest
from conftest import SMALL

from checks.compare import compare, open_tables
from checks.oracle import ORACLE_SQL
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def tables():
    return open_tables(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    problem, _ = compare(spark, tables, QUERIES[name], ORACLE_SQL[name], SMALL)
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as entry_module

    assert not entry_module.entry(spark).isEmpty()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
