"""Every query that has an SQL form gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    from oracle_queries import statements

    assert set(statements()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, ORACLE[name]) is None
