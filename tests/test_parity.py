"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from tests.compare import assert_same, connect

QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, duck, name):
    assert_same(QUERIES[name](spark, small).toPandas(), duck.execute(ORACLE[name]).df())


def test_every_query_but_the_language_models_ones_has_sql():
    assert {name for name in set(QUERIES) - set(ORACLE) if not name.startswith("op")} <= {"pipeline"}


def test_entry(spark):
    flagship = driver.entry(spark)
    assert flagship.count() == 1000
    assert "fraud_score" in flagship.columns
