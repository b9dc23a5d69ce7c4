"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, oracle_connection
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_contract(spark):
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())
    df = driver.entry(spark)
    assert df.columns[0] == "payment_label" and df.count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert name in WITHOUT_SQL and df.count() > 0
    else:
        same, note = compare(df, con, sql)
        assert same, note
