"""Invariants of the product build."""

import re

import pytest
from pyspark.sql import functions as F

from larder import values
from larder.lookups import Lookups
from larder.operators import quality as Q
from larder.plans.builder import RAW_COLUMNS, build_products, category_rules

FRESH = "department = 'Fresh Produce'"


@pytest.fixture(scope="module")
def products(spark):
    df = build_products(spark, 2000, 42).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("n", [1, 7, 50, 500])
def test_any_count(spark, n):
    df = build_products(spark, n)
    assert tuple(df.columns) == RAW_COLUMNS
    rows = df.collect()
    assert [r.product_id for r in rows] == [f"P{i:06d}" for i in range(1, n + 1)]


def test_large_count_keeps_all_rules(spark):
    n = 100_000
    report = Q.check_suite(build_products(spark, n), Q.silver_suite(n, full=True)).collect()
    assert [r.rule for r in report if not r.passed] == []
    assert len(report) == 15


def test_same_rows_for_any_partitioning(spark):
    a = build_products(spark, 1500, 7, partitions=1)
    b = build_products(spark, 1500, 7, partitions=13)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert a.collect() == b.collect()


def test_seeds_differ(spark):
    a, b = build_products(spark, 500, 42), build_products(spark, 500, 99)
    assert a.exceptAll(b).count() > 250


def test_department_counts(products):
    got = {r.department: r["count"] for r in products.groupBy("department").count().collect()}
    assert got == {d["department"]: d["weight"] for d in values.departments()}


def test_all_rules_pass(products):
    assert all(r.passed for r in Q.check_suite(products, Q.silver_suite(2000, full=True)).collect())


def test_curated_rows_come_first(products):
    rows = products.orderBy("product_id").limit(21).collect()
    assert [r.name for r in rows[:20]] == [f["name"] for f in values.fresh_goods()]
    assert [r.cost_price_aud for r in rows[:20]] == [float(f["cost"]) for f in values.fresh_goods()]
    assert rows[20].name.endswith(" bag") and rows[20].unit_of_measure == "kg"
    avocado = next(r for r in rows if r.name == "Tropical Fruit No. 4")
    assert avocado.peak_season_months == [1, 7, 8, 12]


def test_fresh_special_case(spark):
    fresh = build_products(spark, 20_000).filter(FRESH)
    r = fresh.agg(
        F.count("*").alias("n"),
        F.count_if("is_private_label").alias("flagged"),
        F.count_if(F.col("brand") == values.PRIVATE_LABEL_BRAND).alias("own"),
        F.countDistinct("brand").alias("brands"),
        F.count_if(F.col("peak_season_months").isNull()).alias("no_list"),
        F.min("cost_price_aud").alias("low"),
    ).first()
    assert (r.n, r.flagged, r.brands, r.no_list) == (2000, 0, 2, 0)
    assert 0.02 < r.own / r.n < 0.08
    assert r.low >= 0.5


def test_months_are_null_unless_seasonal(products):
    others = products.filter(f"not {FRESH}")
    assert others.filter("size(peak_season_months) = 0").count() == 0
    wobble = others.filter("peak_season_months is null")
    assert wobble.filter("exists(seasonality_vector, x -> x < 0.9 or x > 1.1)").count() == 0


def test_private_label_rate_and_brand_agree(products):
    pantry = products.filter("department = 'Pantry'")
    rate = pantry.agg(F.avg(F.col("is_private_label").cast("double"))).first()[0]
    assert 0.25 <= rate <= 0.45
    own = F.col("brand") == values.PRIVATE_LABEL_BRAND
    assert products.filter(~F.expr(FRESH) & (own != F.col("is_private_label"))).count() == 0


def test_average_prices_look_right(products):
    rows = products.groupBy("department").agg(F.avg("retail_price_aud").alias("p")).collect()
    price = {r.department: r.p for r in rows}
    assert max(price, key=price.get) == "Alcohol" and 35 < price["Alcohol"] < 50
    assert min(price, key=price.get) == "Fresh Produce" and 3.5 < price["Fresh Produce"] < 6


def test_sku_bases(products):
    r = products.groupBy(F.expr(FRESH)).agg(F.min("sku"), F.max(F.length("sku"))).collect()
    assert {x[0]: (x[1][:8], x[2]) for x in r} == {True: ("00000020", 13), False: ("00000030", 13)}


def test_suppliers_belong_to_their_category(spark, products):
    used = products.groupBy("department", "category").agg(F.collect_set("supplier_id").alias("used"))
    pools = category_rules(Lookups(spark)).select("category", "suppliers").collect()
    pool = {r.category: {f"SUP{s:04d}" for s in r.suppliers} for r in pools}
    for r in used.collect():
        assert set(r.used) <= pool[r.category]
        assert 1 <= len(pool[r.category]) <= 3


def test_row_numbers_beyond_a_million(spark):
    from larder.plans.builder import products_for

    ids = spark.range(999_999, 1_000_002)
    rows = products_for(ids, "id", 2_000_000, 42, Lookups(spark)).collect()
    assert [r.product_id for r in rows] == ["P999999", "P1000000", "P1000001"]


def test_own_lookup_tables(spark):
    base = Lookups(spark).table("department")
    renamed = base.withColumn("brands", F.array(F.lit("Only Brand")))
    df = build_products(spark, 300, 42, Lookups(spark, {"department": renamed}))
    brands = {r.brand for r in df.select("brand").distinct().collect()}
    assert brands == {"Only Brand", values.PRIVATE_LABEL_BRAND}
    with pytest.raises(ValueError, match="lacks columns"):
        Lookups(spark, {"department": base.drop("margin")})


def test_departments_of_other_numbers_and_any_length(spark, monkeypatch):
    """Renumbered departments, and lookups too large for a broadcast."""
    base = build_products(spark, 400)
    shifted = Lookups(
        spark,
        {
            "department": Lookups(spark).table("department").withColumn("dept_no", F.expr("dept_no * 3 + 5")),
            "category": Lookups(spark).table("category").withColumn("dept_no", F.expr("dept_no * 3 + 5")),
        },
    )
    assert build_products(spark, 400, 42, shifted).exceptAll(base).count() == 0
    monkeypatch.setattr("larder.lookups.BROADCAST_ROWS", 5)
    large = Lookups(spark, {n: Lookups(spark).table(n) for n in ("category", "fresh", "name_template")})
    assert large.rows("category") == 33
    assert build_products(spark, 400, 42, large).exceptAll(base).count() == 0


def test_build_has_no_shuffle_of_the_rows(spark):
    plan = build_products(spark, 1000)._jdf.queryExecution().executedPlan().toString()
    # Row numbers alone are dealt out, to find their departments, before anything is drawn for a row.
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert dealt.count("_block") >= 1 and not {"idx", "dept_no", "at_spec", "at_category", "subcategory"} & set(dealt)
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_reference_tables():
    assert sum(d["weight"] for d in values.departments()) == 2000
    cats = values.categories()
    assert (len(cats), len(values.taxonomy()), len(values.fresh_goods())) == (33, 114, 20)
    for d in values.departments():
        assert sum(c["department"] == d["department"] for c in cats) >= 3
    for f in values.fresh_goods():
        assert 1 <= f["shelf_life_days"] <= 90 and 0 < f["wastage_rate"] <= 0.30
        assert f["months"] is None or (len(f["months"]) == 12 and min(f["months"]) >= 0)
    assert all(len(v) == 12 for v in values.seasons().values())
    assert len(values.name_templates()) == 99
