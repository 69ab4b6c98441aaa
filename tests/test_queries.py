"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, differences
from larder.catalog import load

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert slow not in plan
    assert differences(df, ORACLES[key], duck) == []


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 10
    prices = [r.avg_retail_price for r in rows]
    assert prices == sorted(prices, reverse=True)
