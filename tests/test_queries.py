"""Every registered query against its SQL in another engine, row by row."""

import pytest

from bazaarlens.plans import registry
from compare import compare, oracle_connection

QUERIES = registry.queries()
SQL = registry.oracle_sql()


# queries whose floors the smallest tables don't reach
LARGER = {"movers": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def oracle(folder):
    return oracle_connection(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, oracle, name):
    if name in LARGER:
        folder, oracle = LARGER[name], oracle_connection(LARGER[name])
    assert compare(QUERIES[name](spark, folder), oracle, SQL[name]) is None
