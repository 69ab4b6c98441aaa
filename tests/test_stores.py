"""Lead times, stored totals, dense keys, the clustered layout, drift between batches."""

import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import drift as D
from larder.operators import leadtime as LT
from larder.operators.quality import GateFailed
from larder.operators.totals import month_brand_deltas
from larder.sources import clustered as C
from larder.sources import keys as K
from larder.sources.totals import Totals


def files_below(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs}


# ---- lead times


def leads_of(spark, n, suppliers=1):
    """Lead times 0..n-1 once each, mixed over suppliers and ten days."""
    return spark.range(n).selectExpr(f"id % {suppliers} as l_suppkey", "date_add(date'2024-01-01', cast(id % 10 as int)) as ship_day", f"(id * 7919) % {n} as lead")


def test_lead_times_by_hand(spark):
    orders = spark.sql("select * from values (1, timestamp_ntz'2024-01-01 23:00:00'), (2, null) as t(o_orderkey, o_orderdate)")
    lines = spark.sql(
        "select * from values (1, 7, timestamp_ntz'2024-01-05 01:00:00'), (1, 7, timestamp_ntz'2023-12-31 00:00:00'), (1, 8, null),"
        " (2, 8, timestamp_ntz'2024-01-05 00:00:00'), (3, 8, timestamp_ntz'2024-01-05 00:00:00'), (null, null, null) as t(l_orderkey, l_suppkey, l_shipdate)"
    )
    leads = LT.lead_days(lines, orders)
    rows = LT.lead_quantiles(LT.merged_summaries(LT.daily_summaries(leads), ["l_suppkey"]), {"p50": 0.5, "p90": 0.9}).collect()
    assert {r.l_suppkey: tuple(r)[1:] for r in rows} == {7: (2, 0, 1, -1, 4), 8: (3, 3, 0, None, None), None: (1, 1, 0, None, None)}


@pytest.mark.parametrize("suppliers", [1, 3])
def test_merged_days_are_as_good_as_one_pass(spark, suppliers):
    n = 300_000
    leads = leads_of(spark, n, suppliers).repartition(16)
    of_days = LT.merged_summaries(LT.daily_summaries(leads), ["l_suppkey"])
    at_once = LT.merged_summaries(LT.daily_summaries(leads.withColumn("ship_day", F.lit(date(2024, 1, 1)))), ["l_suppkey"])
    for summaries in (of_days, at_once):
        for r in LT.lead_quantiles(summaries, {"p50": 0.5, "p90": 0.9}).collect():
            mine = sorted((i * 7919) % n for i in range(n) if i % suppliers == r.l_suppkey)
            for got, q in ((r.p50, 0.5), (r.p90, 0.9)):
                assert abs(mine.index(got) / len(mine) - q) < 0.001
            assert r.n_lines == len(mine)


def test_a_hot_supplier_is_summed_up_in_every_task(spark):
    plan = LT.daily_summaries(leads_of(spark, 1000))._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_bigint" in plan


def test_counted_lead_times(spark):
    """Exact beyond the items of a sketch, and no sketch for each supplier and day."""
    n = 30_000
    leads = leads_of(spark, n, 2).unionByName(spark.sql("select 5L l_suppkey, date'2024-01-01' ship_day, explode(array(-2L, null, 3L)) lead"), allowMissingColumns=True)
    daily = LT.daily_counts(leads)
    assert "kll" not in daily._jdf.queryExecution().executedPlan().toString()
    rows = LT.count_quantiles(LT.merged_counts(daily, ["l_suppkey"]), ["l_suppkey"], {"p50": 0.5, "p90": 0.9}).collect()
    got = {r.l_suppkey: tuple(r)[1:] for r in rows}
    assert got.pop(5) == (3, 1, 1, -2, 3) and set(got) == {0, 1}
    for s, r in got.items():
        mine = sorted((i * 7919) % n for i in range(n) if i % 2 == s)
        assert r == (len(mine), 0, 0, mine[len(mine) // 2 - 1], mine[len(mine) * 9 // 10 - 1])


def test_lead_times_of_an_empty_table(spark):
    assert LT.lead_quantiles(LT.merged_summaries(LT.daily_summaries(leads_of(spark, 10).where("false")), ["l_suppkey"]), {"p": 0.5}).count() == 0


# ---- stored totals

GROUPS = ["ship_year", "ship_month", "p_brand"]


@pytest.fixture
def batches(spark, sf_dir):
    lines, part = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part"))
    lines = lines.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 50 != 1, F.col("l_shipdate")))
    made = [month_brand_deltas(lines.where(F.col("l_orderkey") % 3 == b), part) for b in range(3)]
    return made, month_brand_deltas(lines, part), lines


def rows_in(df):
    return sorted((tuple(map(str, r)) for r in df.drop("orders").collect()))


def test_totals_after_increments_equal_a_recount(spark, tmp_path, batches):
    made, whole, lines = batches
    path = str(tmp_path / "totals")
    store = Totals(spark, path, made[0].schema, GROUPS, ["orders"])
    assert store.read().count() == 0
    for b, df in enumerate(made):
        before = files_below(path)
        assert store.add(df, b)
        after = files_below(path)
        assert before.items() <= after.items()  # what was stored is left alone
    assert rows_in(store.read()) == rows_in(whole)
    store.add(made[1], 1)
    assert rows_in(store.read()) == rows_in(whole)
    store.fold(1)
    assert rows_in(store.read()) == rows_in(whole) and sorted(os.listdir(path)) == ["part=base-000000000001", "part=batch-000000000002"]
    assert not store.add(made[0], 0) and rows_in(store.read()) == rows_in(whole)
    # Distinct orders over all groups come from the sketches, within three standard errors.
    got = store.read().agg(F.hll_sketch_estimate(F.hll_union_agg("orders"))).first()[0]
    want = lines.select("l_orderkey").distinct().count()
    assert abs(got - want) <= 3 * 0.0163 * want


def test_totals_of_a_run_that_died(spark, tmp_path, batches):
    made, whole, _ = batches
    path = str(tmp_path / "totals")
    store = Totals(spark, path, made[0].schema, GROUPS, ["orders"])
    for b, df in enumerate(made):
        store.add(df, b)
    # A base whose write was cut short doesn't count; one that is complete does, whatever old folders are left.
    store.fold(0)
    shutil.copytree(f"{path}/part=base-000000000000", f"{path}/part=base-000000000002")
    os.remove(f"{path}/part=base-000000000002/_SUCCESS")
    assert store.folded() == 0 and rows_in(store.read()) == rows_in(whole)
    shutil.copytree(f"{path}/part=batch-000000000001", str(tmp_path / "kept"))
    store.fold(2)
    shutil.copytree(str(tmp_path / "kept"), f"{path}/part=batch-000000000001")
    assert rows_in(store.read()) == rows_in(whole)
    with pytest.raises(ValueError, match="numbered"):
        store.add(made[0], -1)


def test_one_year_of_totals_opens_its_folder_alone(spark, tmp_path, batches):
    made, _, _ = batches
    store = Totals(spark, str(tmp_path / "totals"), made[0].schema, GROUPS, ["orders"])
    store.add(made[0], 0)
    year = store.read().where("ship_year = 1996")
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_year" in plan and "(ship_year" in plan
    assert {r.ship_month[:4] for r in year.collect()} == {"1996"}


# ---- dense keys


def numbers(spark, path, df):
    return {tuple(r)[:-1]: r.dense_key for r in K.read_keys(spark, path, df.schema).collect()}


def test_three_loads_give_stable_numbers_without_gaps(spark, tmp_path):
    path = str(tmp_path / "keys")
    def load(lo, hi):
        return spark.range(lo, hi).selectExpr("if(id = 0, null, id) as a", "concat('k', id % 7) as b")
    sizes, seen = [], {}
    for lo, hi in ((0, 100), (50, 300), (50, 300), (0, 1000)):
        df = load(lo, hi).unionByName(load(lo, hi))
        sizes.append(K.add_keys(df, path, ["a", "b"]))
        now = numbers(spark, path, df)
        assert seen.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1))
        seen = now
    assert sizes == [100, 200, 0, 700]


def test_a_load_that_died_is_numbered_again(spark, tmp_path):
    path = str(tmp_path / "keys")
    df = spark.range(500).selectExpr("id as a")
    K.add_keys(df.where("a < 200"), path, ["a"])
    first = numbers(spark, path, df)
    K.add_keys(df, path, ["a"])
    want = numbers(spark, path, df)
    os.remove(f"{path}/upto={500:018d}/_SUCCESS")
    assert numbers(spark, path, df) == first
    assert K.add_keys(df, path, ["a"]) == 300 and numbers(spark, path, df) == want
    assert K.add_keys(df.where("false"), path, ["a"]) == 0


def test_a_million_keys_spread_over_tasks(spark, tmp_path):
    path = str(tmp_path / "keys")
    assert K.add_keys(spark.range(1_000_000).selectExpr("cast(id as string) as a"), path, ["a"]) == 1_000_000
    keys = K.read_keys(spark, path, spark.range(1).selectExpr("'' as a").schema)
    assert keys.agg(F.min("dense_key"), F.max("dense_key"), F.countDistinct("dense_key")).first()[:] == (1, 1_000_000, 1_000_000)
    slots = spark.range(1_000_000).selectExpr(f"pmod(xxhash64(cast(id as string)), {K.SLOTS}) as s").groupBy("s").count()
    assert slots.agg(F.max("count")).first()[0] < 400


# ---- clustered layout


def test_a_range_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.range(40_000).selectExpr(
        "if(id % 100 = 0, null, pmod(xxhash64(id), 1000)) as a", "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(pmod(xxhash64(id, 1), 8760) as int)) as t",
        "if(id % 3 = 0, 5, id % 997) as hot", "id",
    )
    C.write_clustered(df, path, ["a", "t"], 64)
    span = (datetime(2024, 3, 1), datetime(2024, 4, 1))
    ranges = {"a": (100, 200), "t": span}
    every = spark.read.parquet(f"{path}_manifest").count()
    assert every >= 50 and len(C.files_in(spark, path, ranges)) <= every / 4
    got = {r.id for r in C.read_range(spark, path, df.schema, ranges).collect()}
    want = {r.id for r in df.where(F.col("a").between(100, 200) & F.col("t").between(*map(F.lit, span))).collect()}
    assert got == want and got
    assert C.read_range(spark, path, df.schema, {"a": (5000, 6000)}).count() == 0
    assert C.read_range(spark, path, df.schema, {}).count() == 40_000


def test_a_hot_value_fills_many_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 5, id % 997) as hot", "cast(id as double) as x")
    C.write_clustered(df, path, ["hot", "x"], 30)
    sizes = [r.n_rows for r in spark.read.parquet(f"{path}_manifest").collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 3000


def test_odd_clustered_tables(spark, tmp_path):
    empty = spark.range(10).selectExpr("id", "cast(null as double) as x").where("false")
    C.write_clustered(empty, str(tmp_path / "empty"), ["id", "x"], 4)
    assert C.read_range(spark, str(tmp_path / "empty"), empty.schema, {"id": (0, 5)}).count() == 0
    nulls = spark.range(10).selectExpr("id", "cast(null as double) as x")
    C.write_clustered(nulls, str(tmp_path / "nulls"), ["x"], 4)
    assert C.read_range(spark, str(tmp_path / "nulls"), nulls.schema, {}).count() == 10
    with pytest.raises(ValueError, match="manifest"):
        C.files_in(spark, str(tmp_path / "none"), {})
    with pytest.raises(ValueError, match="64-bit"):
        C.write_clustered(nulls, str(tmp_path / "wide"), ["x"] * 11, 4)


# ---- drift


def priced(spark, lo, factor="1.0", missing="false"):
    return spark.range(lo, lo + 4000).selectExpr(
        f"if({missing}, null, cast((id * 7919) % 1000 as double) * {factor}) as price", "concat('c', id % 5) as kind", "cast(id % 40 as double) as qty"
    )


def test_a_shifted_price_stops_the_run(spark, tmp_path):
    gate = D.DriftGate(spark, str(tmp_path / "profiles"), ["price", "qty"], ["kind"])
    gate.check(priced(spark, 0), 1)
    gate.check(priced(spark, 4000), 2)
    with pytest.raises(GateFailed, match="drifted in price$"):
        gate.check(priced(spark, 8000, factor="1.6"), 3)
    with pytest.raises(GateFailed, match="drifted in price$"):
        gate.check(priced(spark, 8000, missing="id % 10 = 0"), 3)
    with pytest.raises(GateFailed, match="drifted in kind$"):
        gate.check(priced(spark, 8000).withColumn("kind", F.lit("c1")), 3)
    with pytest.raises(GateFailed, match="drifted in kind, price, qty"):
        gate.check(priced(spark, 0).where("false"), 3)
    assert sorted(os.listdir(tmp_path / "profiles")) == ["batch=1", "batch=2"]
    gate.check(priced(spark, 8000), 3)
    gate.check(priced(spark, 4000), 2)  # a batch repeated is held against the one before it


def test_distances_by_hand(spark):
    def told(rows):
        return spark.createDataFrame([("x", b, None, n) for b, n in enumerate(rows)], D.SCHEMA)

    import math

    a, b = [10, 40, 50], [0, 70, 30]
    p, q = ([(n + 0.5) / (100 + 1.5) for n in v] for v in (a, b))
    r = D.drift(told(a), told(b), ["x"]).first()
    assert r.psi == pytest.approx(sum((y - x) * math.log(y / x) for x, y in zip(p, q)))
    assert r.ks == pytest.approx(abs(40 / 90 - 70 / 100)) and r.null_change == pytest.approx(0.1) and not r.passed
    same = D.drift(told(a), told(a), []).first()
    assert (same.psi, same.ks, same.null_change, same.passed) == (0.0, None, 0.0, True)


def test_columns_without_values_have_a_profile(spark):
    df = spark.sql("select cast(null as double) as x, cast(null as string) as s from range(5)")
    edges = D.edges_of(df, ["x"], ["s"])
    assert edges == {"x": [], "s": []}
    assert sorted(tuple(r) for r in D.profile(df, edges).select("name", "bin", "n").collect()) == [("s", 0, 5), ("s", 1, 0), ("x", 0, 5), ("x", 1, 0)]
