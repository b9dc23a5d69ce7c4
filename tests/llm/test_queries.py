"""Registered queries against their SQL, on whole small tables."""

import pytest

from checks.compare import compare, oracle_connection
from tripmart.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    same, note = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert same, note
