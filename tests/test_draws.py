"""Keyed draws."""

import pytest
from pyspark.sql import functions as F

from larder.functions import draws as D


def python_draw(seed, row_id, name):
    key, factor = D.draw_key(seed, name)
    x = (row_id & D.MASK) ^ key ^ ((((row_id >> 32) & 0x7FFFFFFF) * factor) & D.MASK)
    for shift, mult in D.MIX_STEPS:
        x = ((x ^ (x >> shift)) * mult) & D.MASK
    return (x ^ (x >> D.MIX_LAST)) / 2**32


def test_draws_equal_plain_python_and_each_other(spark):
    ids = [0, 1, 2, 41, 2**31, 2**32 - 1, 2**32, 2**40 + 3]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    staged = D.with_draws(df, 42, "id", ["a", "b"])
    rows = staged.selectExpr("*", f"{D.draw(42, 'id', 'a')} as once").collect()
    for r in rows:
        assert r.u_a == r.once == python_draw(42, r.id, "a")
        assert r.u_b == python_draw(42, r.id, "b")
    assert len({r.u_a for r in rows}) == len(ids)


def test_draws_are_uniform_and_independent(spark):
    df = D.with_draws(spark.range(100_000), 1, "id", ["a", "b"])
    r = df.agg(
        F.avg("u_a"), F.stddev("u_a"), F.corr("u_a", "u_b"), F.min("u_a"), F.max("u_a")
    ).first()
    assert abs(r[0] - 0.5) < 0.005
    assert abs(r[1] - 12**-0.5) < 0.005
    assert abs(r[2]) < 0.01
    assert 0 <= r[3] < r[4] < 1
    counts = df.groupBy(F.floor(F.col("u_a") * 16)).count().collect()
    assert len(counts) == 16
    assert all(abs(c["count"] - 6250) < 400 for c in counts)


def test_triangular_stays_in_range(spark):
    u = spark.range(10_001).selectExpr("id / 10001D as u")
    r = u.selectExpr(f"{D.triangular('u', '2D', '8D', '40D')} as x").agg(
        F.min("x"), F.max("x"), F.avg("x")
    ).first()
    assert 2 <= r[0] and r[1] <= 40
    assert abs(r[2] - (2 + 8 + 40) / 3) < 0.05


@pytest.mark.parametrize("pool", [1, 2, 3, 60])
def test_distinct_picks(spark, pool):
    df = D.with_draws(spark.range(3000), 5, "id", ["x", "y", "z"])
    df = df.selectExpr("*", "cast(id % 3 as int) + 1 as want")
    rows = D.with_distinct_picks(df, ("u_x", "u_y", "u_z"), pool, "want", "picks").collect()
    for r in rows:
        assert len(r.picks) == len(set(r.picks)) == min(r.want, pool)
        assert all(1 <= p <= pool for p in r.picks)
    assert {p for r in rows for p in r.picks} == set(range(1, pool + 1))


def test_cents_round_half_up(spark):
    got = spark.sql(f"select {D.to_cents('0.125D')} a, {D.to_cents('2.5D')} b").first()
    assert [str(x) for x in got] == ["0.13", "2.50"]
