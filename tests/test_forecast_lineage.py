"""Fitted forecast, column lineage, facts joined to the version of their time."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larder.catalog.lineage import GOLD_EDGES
from larder.operators import demand as DM
from larder.operators import smoothing as SM
from larder.operators.lineage import Edge, column_edges
from larder.operators.valid import join_valid
from larder.plans.layer_run import LayerConfig, read_lineage, run_layers, trace_to_landing
from larder.plans.part_products import read_landing_products

MONDAY = date(1970, 1, 5)


def sales(spark, weeks):
    """(product, week, quantity) as lines on some day of the week."""
    rows = [(p, None if w is None else MONDAY + timedelta(days=7 * w + w % 7), float(q)) for p, w, q in weeks]
    return spark.createDataFrame(rows, "l_partkey bigint, l_shipdate date, l_quantity double")


def brute_fit(first, y, grid=SM.GRID, horizon=4):
    n = len(y)
    train = n - min(26, n // 4)
    best = None
    for i, (alpha, beta, gamma) in enumerate(grid):
        known = y[: min(52, train)]
        level, trend, season, fit, ae, se = sum(known) / len(known), 0.0, [0.0] * 13, 0.0, 0.0, 0.0
        for t, v in enumerate(y):
            p = (first + t) % 52 // 4
            f = level + trend + season[p]
            e, off = v - f, v - max(f, 0.0)
            if t < train:
                fit += e * e
            else:
                ae, se = ae + abs(off), se + off * off
            level, trend = level + trend + alpha * e, trend + beta * e
            season[p] += gamma * e
        if best is None or fit < best[0]:
            best = (fit, i, level, trend, season, ae, se)
    _, i, level, trend, season, ae, se = best
    ahead = [max(level + h * trend + season[(first + n + h - 1) % 52 // 4], 0.0) for h in range(1, horizon + 1)]
    naive = [y[t] - (y[t - 52] if t >= 52 else y[t - 1]) for t in range(train, n)]
    tested = n - train
    return grid[i], ahead, *((x / tested if tested else None) for x in (ae, se, sum(map(abs, naive)), sum(d * d for d in naive)))


def series(kind, n, rng):
    if kind == "season":
        return [max(0.0, 40 + 30 * math.sin(2 * math.pi * t / 52) + rng.gauss(0, 3)) for t in range(n)]
    if kind == "trend":
        return [5 + 0.5 * t + rng.gauss(0, 2) for t in range(n)]
    return [rng.choice([0, 0, 0, 0, 7, 20]) * 1.0 for _ in range(n)]


@pytest.fixture(scope="module")
def demand_series():
    rng = random.Random(9)
    out = {}
    for i, (kind, n) in enumerate([("season", 260), ("trend", 200), ("rare", 300), ("rare", 40), ("rare", 3), ("rare", 1), ("season", 90)]):
        y = [round(abs(v), 2) for v in series(kind, n, rng)]
        y[0], y[-1] = y[0] or 1.0, y[-1] or 2.0
        out[i] = (1300 + 17 * i, y)
    return out


def test_fitted_forecast_against_brute_force(spark, demand_series):
    lines = sales(spark, [(p, first + t, q) for p, (first, y) in demand_series.items() for t, q in enumerate(y) if q])
    got = {}
    for r in SM.fitted_forecast(DM.weekly_arrays(DM.weekly_demand(lines))).collect():
        got.setdefault(r.l_partkey, {})[r.week] = r
    assert {*got} == {*demand_series}
    for p, (first, y) in demand_series.items():
        grid, ahead, mae, mse, naive, naive_mse = brute_fit(first, y)
        rows = got[p]
        assert sorted(rows) == [first + len(y) + h for h in range(4)]
        for h, f in enumerate(ahead):
            r = rows[first + len(y) + h]
            assert (r.alpha, r.beta, r.gamma) == grid and r.n_weeks == len(y) and r.n_tested == min(26, len(y) // 4)
            assert r.forecast == pytest.approx(f, abs=1e-9) and r.forecast >= 0
            for value, want in ((r.mae, mae), (r.naive_mae, naive)):
                assert value == (None if want is None else pytest.approx(want, abs=1e-9))
            for value, want in ((r.rmse, mse), (r.naive_rmse, naive_mse)):
                assert value == (None if want is None else pytest.approx(math.sqrt(want), abs=1e-9))
    assert got[0][1300 + 260].gamma > 0 and got[1][1317 + 200].beta > 0  # season and trend are found


def test_better_than_naive_on_lineitem(spark, sf_dir):
    weekly = DM.weekly_demand(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    last = SM.fitted_forecast(DM.weekly_arrays(weekly), horizon=1).where("n_tested > 0")
    r = last.agg(*[F.expr(f"sqrt(sum({c} * {c} * n_tested) / sum(n_tested))").alias(c) for c in ("rmse", "naive_rmse")]).first()
    assert r.rmse < 0.9 * r.naive_rmse


def test_undated_and_far_off_sales(spark):
    lines = sales(spark, [(1, 1400, 3), (1, 1402, 4), (1, None, 5), (2, None, 6), (2, None, 1)])
    odd = spark.createDataFrame([(1, date(9000, 1, 1), 9.0), (3, date(1, 1, 1), 2.0)], lines.schema)
    weekly = DM.weekly_demand(lines.union(odd))
    got = DM.seasonal_naive_forecast(weekly).collect()
    undated = {r.l_partkey: float(r.demand) for r in got if r.week is None}
    assert undated == {1: 14.0, 2: 7.0, 3: 2.0}
    assert [float(r.demand) for r in sorted((r for r in got if r.week and r.week < 1403), key=lambda r: r.week)] == [3.0, 0.0, 4.0]
    assert len(got) == 3 + 4 + 3
    assert {r.l_partkey for r in DM.weekly_arrays(weekly).collect()} == {1}
    assert SM.fitted_forecast(DM.weekly_arrays(weekly.where("false"))).collect() == []


# Lineage ------------------------------------------------------------------------------------------


def test_gold_lineage_is_the_hand_made_list(spark, sf_dir, tmp_path):
    names = {layer: f"tl_{layer}" for layer in ("bronze", "silver", "gold")}
    cfg = LayerConfig(landing=f"{sf_dir}/part.parquet", location=str(tmp_path), expected_rows=None, gates=False, **names)
    run_layers(spark, cfg, read_landing_products(spark, sf_dir))
    gold = read_lineage(spark, cfg, cfg.gold).collect()
    assert {r.source_table for r in gold} == {"tl_silver.dim_product"}
    assert sorted((r.output_column, r.source_column, r.position) for r in gold) == sorted(GOLD_EDGES)
    assert len({r.output_column for r in gold}) == 22
    silver = read_lineage(spark, cfg, cfg.silver).collect()
    assert {r.output_column: r.source_table for r in silver}["_silver_loaded_at_utc"] is None
    assert all(r.output_column == r.source_column for r in silver if r.source_table)
    back = {}
    for r in trace_to_landing(spark, cfg).collect():
        back.setdefault(r.output_column, set()).add((r.source_table, r.source_column))
    assert ("part.parquet", "p_brand") in back["brand"] and len(back) == 22
    assert {c for t, c in back["margin_pct"] if t == "part.parquet"} == {"p_partkey", "p_size"}


def test_edges_through_joins_renames_unions_windows_and_subqueries(spark, schema):
    spark.range(3).selectExpr("id as k", "id * 2 as v", "array(id) as many").write.saveAsTable(f"{schema}.a")
    spark.range(3).selectExpr("id as k2", "id + 1 as w").write.saveAsTable(f"{schema}.b")
    a, b = spark.table(f"{schema}.a"), spark.table(f"{schema}.b")

    def edges(df):
        return {(e.output_column, e.source_table and e.source_table.split(".")[-1], e.source_column) for e in column_edges(df)}

    joined = a.join(b, F.col("k") == F.col("k2")).selectExpr("k as key", "v + w as both", "'x' as fixed").withColumnRenamed("key", "id")
    assert edges(joined) == {("id", "a", "k"), ("both", "a", "v"), ("both", "b", "w"), ("fixed", None, None)}
    assert [e.expression for e in column_edges(joined)][0] == "k"
    both = a.select("k", "v").union(b.select("w", "k2"))
    assert edges(both) == {("k", "a", "k"), ("k", "b", "w"), ("v", "a", "v"), ("v", "b", "k2")}
    selfjoin = a.alias("l").join(a.alias("r"), F.expr("l.k = r.v")).selectExpr("l.v - r.k as d")
    assert edges(selfjoin) == {("d", "a", "v"), ("d", "a", "k")}
    assert edges(a.groupBy("k").agg(F.sum("v").alias("s"))) == {("k", "a", "k"), ("s", "a", "v")}
    a.createOrReplaceTempView("lineage_a")
    b.createOrReplaceTempView("lineage_b")
    ranked = spark.sql("select k, row_number() over (partition by k order by v) as n, x from lineage_a lateral view explode(many) t as x")
    assert {("n", "k"), ("n", "v"), ("x", "many"), ("k", "k")} == {(o, c) for o, _, c in edges(ranked)}
    sub = spark.sql("select v + (select max(w) from lineage_b) as z from lineage_a")
    assert {(o, c) for o, _, c in edges(sub)} == {("z", "v"), ("z", "w")}
    view = f"{schema}.seen"
    spark.sql(f"create view {view} as select k as kk, v from {schema}.a")
    assert column_edges(spark.table(view).selectExpr("kk + 1 as one"))[0] == Edge("one", view, "kk", column_edges(spark.table(view).selectExpr("kk + 1 as one"))[0].expression)


# Versions valid at a time ---------------------------------------------------------------------------


def test_versions_valid_at_a_time(spark):
    rng = random.Random(4)
    start = date(2020, 1, 1)
    versions, facts = [], []
    for k in range(40):
        day = start + timedelta(days=rng.randrange(0, 400))
        for v in range(rng.randrange(0, 5)):
            end = day + timedelta(days=rng.randrange(1, 500))
            versions.append((k, f"{k}-{v}", day, None if v == 3 else end))
            day = end + timedelta(days=rng.choice([0, 0, 10]))
    for i in range(3000):
        k = 7 if i % 3 == 0 else rng.choice([*range(45), None])  # one key holds a third of the facts
        at = datetime(2019, 6, 1) + timedelta(hours=rng.randrange(0, 24 * 1500))
        facts.append((i, k, None if i % 97 == 0 else at))
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    v = spark.createDataFrame(versions, "key int, name string, valid_from date, valid_to date")
    want = {}
    for i, k, at in facts:
        hit = [n for kk, n, a, b in versions if kk == k and at and a <= at.date() and (b is None or at.date() < b)]
        assert len(hit) <= 1
        want[i] = hit[0] if hit else None
    for days in (1, 180, 10_000):
        joined = join_valid(f, v, {"k": "key"}, "at", ["name"], days=days)
        assert joined.columns == ["id", "k", "at", "name"]
        assert {r.id: r.name for r in joined.collect()} == want and joined.count() == len(facts)
    plan = join_valid(f, v, {"k": "key"}, "at", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan  # the spread versions outgrow what their files' size promises
    with pytest.raises(ValueError):
        join_valid(f, v.withColumnRenamed("name", "K"), {"k": "key"}, "at", ["K"])
    assert join_valid(f.where("false"), v, {"k": "key"}, "at", ["name"]).collect() == []
    assert join_valid(f, v.where("false"), {"k": "key"}, "at", ["name"]).where("name is null").count() == len(facts)


def test_fitted_weeks_side_by_side(spark, demand_series, monkeypatch):
    """Weeks are folded for many products at once, not one by one in an interpreted function; slabs don't show."""
    lines = sales(spark, [(p, first + t, q) for p, (first, y) in demand_series.items() for t, q in enumerate(y) if q])
    arrays = DM.weekly_arrays(DM.weekly_demand(lines))
    whole = SM.fitted_forecast(arrays)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan
    want = sorted(whole.collect())
    monkeypatch.setattr(SM, "ENTRIES", 400)
    assert sorted(SM.fitted_forecast(arrays).collect()) == want


def test_lags_without_an_object_per_week(spark):
    """Weeks become rows before their lags are looked up; a week that only has missing quantities sold 0."""
    weekly = spark.createDataFrame([(1, 1400, 3), (1, 1401, None), (1, 1402, 4)], "l_partkey bigint, week int, qty int")
    weekly = weekly.withColumn("qty", F.col("qty").cast("decimal(22,2)"))
    got = DM.seasonal_naive_forecast(weekly, season=2, horizon=1)
    assert "named_struct" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.week: tuple(None if x is None else float(x) for x in r[2:]) for r in got.collect()}
    assert rows == {1400: (3, None, 0), 1401: (0, None, 0.75), 1402: (4, 3, 0.75), 1403: (None, 0, 1.75)}
