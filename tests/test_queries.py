"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from opinionlake.registry import all_queries
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    query = QUERIES[name]
    if query.sql is None:
        assert query.run(spark, SF).count() > 0
    else:
        assert difference(spark, con, query, SF) is None


def test_contract_lists_every_query():
    assert set(contract.queries()) >= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
