"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as driver
from saldoflow.checks import oracle, queries
from tests.compare import connect, differences
from tests.conftest import SF_DIR

QUERIES, ORACLE = queries.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == ""


def test_entry_returns_rows_with_a_stable_schema(spark):
    df = driver.entry(spark)
    assert df.columns == ["fecha_corte", "uc", "sub", "columna", "valor"]
    assert df.count() > 0
