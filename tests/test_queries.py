"""Every query of the clickstream jobs against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from clickstats.plans.registered import QUERIES
from conftest import SF_SMALL
from tools.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in E.oracle_sql(), "every query has an oracle"
    r = compare(spark, name, SF_SMALL, con)
    assert r["columns_match"], r
    assert r["rows_match"], r
    assert r["spark_rows"] > 0, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["item_id", "window_end", "count", "rank"]
    assert df.count() > 0
