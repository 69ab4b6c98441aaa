"""Largest-remainder allocation."""

import pytest
from pyspark.sql import functions as F

from larder.lookups import Lookups
from larder.operators.allocate import allocate, bounds, expand


def by_hand(weights, n):
    total = sum(weights)
    shares = [w * n // total for w in weights]
    order = sorted(range(len(weights)), key=lambda i: (-(weights[i] * n % total), i))
    for i in order[: n - sum(shares)]:
        shares[i] += 1
    return shares


def allocated(spark, weights, n):
    df = spark.createDataFrame(list(enumerate(weights)), "alloc_no int, weight bigint")
    return [r.n for r in allocate(df, n).orderBy("alloc_no").collect()]


def test_fifty_over_departments(spark):
    df = allocate(Lookups(spark).table("department"), 50)
    got = [r.n for r in df.orderBy("alloc_no").collect()]
    assert got == [13, 6, 6, 5, 4, 4, 4, 3, 3, 2]


@pytest.mark.parametrize("n", [0, 1, 7, 13, 1999, 2001, 10**12 + 7])
def test_equals_by_hand(spark, n):
    weights = [500, 240, 240, 200, 160, 160, 160, 120, 120, 100]
    got = allocated(spark, weights, n)
    assert got == by_hand(weights, n)
    assert sum(got) == n


def test_many_equal_remainders(spark):
    weights = [3] * 700 + [1] * 1300
    assert allocated(spark, weights, 1234) == by_hand(weights, 1234)


def test_equal_weights_leave_no_hot_task(spark):
    """100,000 equal remainders: their ranks are taken in many small windows."""
    n = 100_000
    df = spark.range(n).selectExpr("id as alloc_no", "7L as weight").repartition(8)
    got = allocate(df, 2 * n + n // 4)
    assert got.agg(F.sum("n"), F.min("n"), F.max("n")).first() == (2 * n + n // 4, 2, 3)
    assert got.filter("n = 3").agg(F.max("alloc_no")).first()[0] == n // 4 - 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_rem" in plan and "_slot" in plan


def test_text_ties(spark):
    df = spark.createDataFrame([(f"b{i:02d}", 1) for i in range(30)], "brand string, weight bigint")
    got = {r.brand: r.n for r in allocate(df, 40, tie="brand").collect()}
    assert got == {f"b{i:02d}": 2 if i < 10 else 1 for i in range(30)}


def by_hand_groups(sizes):
    return [(d, k) for d, s in enumerate(sizes) for k in range(1, s + 1)]


@pytest.mark.parametrize("groups", [1, 10, 64, 65, 300])
@pytest.mark.parametrize("stride", [7, 50, 65_536])
def test_expansion(spark, groups, stride):
    """One way for any number of groups; numbers outside 1..total belong to none."""
    sizes = [(i * 7 + 3) % 5 for i in range(groups)]
    alloc = spark.createDataFrame(list(enumerate(sizes)), "dept_no int, n long")
    total = sum(sizes)
    rows = spark.range(-3, total + 20).selectExpr("id", "'x' as more").unionByName(
        spark.sql("select cast(null as bigint) as id, 'x' as more")
    )
    got = expand(rows, "id", alloc, stride=stride)
    assert got.columns == ["id", "more", "dept_no", "in_group"]
    got = got.orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, total + 1))
    assert [(r.dept_no, r.in_group) for r in got] == by_hand_groups(sizes)


def test_bounds(spark):
    sizes = [(i * 7) % 5 for i in range(300)]
    alloc = spark.createDataFrame(list(enumerate(sizes)), "dept_no int, n long")
    got = [(r.lo, r.hi) for r in bounds(alloc, chunk=16).orderBy("dept_no").collect()]
    ends = [sum(sizes[: i + 1]) for i in range(300)]
    assert got == [(e - s, e) for e, s in zip(ends, sizes, strict=True)]


def test_many_small_groups_expand_in_linear_time(spark):
    n = 300_000
    alloc = spark.range(n).selectExpr("cast(id as int) as dept_no", "1L as n")
    got = expand(spark.range(1, n + 1), "id", alloc)
    assert got.agg(F.count("*"), F.count_if(F.expr("dept_no = id - 1 and in_group = 1"))).first() == (n, n)
