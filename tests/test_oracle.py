"""Every registered query with SQL beside it gives the same rows; the others give rows."""

import pytest

import __spark_entry__ as contract
from checks.run import difference

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, duck, sf_dir, name):
    assert difference(spark, duck, QUERIES[name], ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
