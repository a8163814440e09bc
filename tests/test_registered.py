"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# sf0.001 is too small for these to have results
MAY_BE_EMPTY = {"adaptive_threshold_alerts", "stream_adaptive_threshold", "customers_left_anti_orders", "sensor_outliers"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert df.count() > 0
        return
    problems = compare(df, con, SQL[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows"]
    assert not problems


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 30 and df.columns == ["start", "end", "total", "n"]
