"""Every registered query that has a SQL counterpart against it."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
QUERIES = contract.queries()
ORDERED = {"brand_topn", "detail_page", "dau_hourly", "doc_search", "stream_detail_page"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Queries that SQL cannot express have brute-force tests of their own.
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    only_spark, only_sql, _ = compare(df, con, ORACLES[name], name in ORDERED)
    assert (only_spark[:3], only_sql[:3]) == ([], [])


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["tm_id", "tm_name", "sum_amount"] and result.count() == 10
