"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_module
from daytally.plans import oracle, registry
from tests.compare import differences, duck

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql_and_is_registered():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert SQL.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, con, name):
    only_spark, only_duck = differences(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert not only_spark, list(only_spark.items())[:3]
    assert not only_duck, list(only_duck.items())[:3]


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert rows.columns == ["ts_date", "daily_pu", "daily_rev", "daily_profit"]
    assert rows.count() > 0
