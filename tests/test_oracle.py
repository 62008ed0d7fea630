"""Every registered query against its SQL on the driver's tables."""

import pytest

import __spark_entry__ as entry_point
from tests.compare import assert_same, duck

QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir, con):
    assert_same(QUERIES[name](spark, sf_dir), con, SQL[name])


def test_every_query_of_the_reference_has_sql():
    assert {n for n in QUERIES if n != "pipeline" and not n.startswith("op")} <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
