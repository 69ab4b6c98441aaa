"""Scalar rules on hand-made rows."""

from decimal import Decimal

import pytest

from larder import values
from larder.functions import rules as R
from larder.operators.layers import to_gold, to_silver


def one(spark, *exprs):
    return spark.range(1).selectExpr(*[f"{e} as c{i}" for i, e in enumerate(exprs)]).first()


def money(x):
    return "cast(null as decimal(10,2))" if x is None else f"cast({x}BD as decimal(10,2))"


@pytest.mark.parametrize(
    "price, tier",
    [("4.99", "Budget"), ("5.00", "Mid"), ("19.99", "Mid"), ("20.00", "Premium"), (None, "Premium")],
)
def test_price_tier_edges(spark, price, tier):
    assert one(spark, R.price_tier(money(price)))[0] == tier


@pytest.mark.parametrize(
    "retail, cost, margin",
    [("7.49", "5.30", "29.24"), ("0", "1", None), ("1", "20", None), (None, "1", None)],
)
def test_margin(spark, retail, cost, margin):
    got = one(spark, R.margin_pct(money(retail), money(cost)))[0]
    assert got == (None if margin is None else Decimal(margin))


@pytest.mark.parametrize("price, ending, want", [("0.40", "0.79", "0.79"), ("5.30", "0.49", "5.49")])
def test_charm_price(spark, price, ending, want):
    assert one(spark, R.charm_price(money(price), money(ending)))[0] == Decimal(want)


@pytest.mark.parametrize(
    "cost, retail, want",
    [("0.50", "0.49", "0.79"), ("1.55", "1.49", "2.49"), ("1.20", "1.49", "1.49"), ("0.99", "0.95", "1.49")],
)
def test_retail_above_cost(spark, cost, retail, want):
    assert one(spark, R.retail_above_cost(money(retail), money(cost)))[0] == Decimal(want)


@pytest.mark.parametrize(
    "unit, size, want",
    [("each", 1, ""), ("g", 500, "500g"), ("L", 1.25, "1.25L"), ("pack", 250, "250pk"), ("L", 0.5, "0.5L")],
)
def test_pack_label(spark, unit, size, want):
    assert one(spark, R.pack_label(f"'{unit}'", f"{float(size)}D"))[0] == want


@pytest.mark.parametrize("size, want", [(0.5, "500g bag"), (1.0, "1kg bag"), (1.5, "1kg bag"), (2.0, "2kg bag")])
def test_bag_label(spark, size, want):
    assert one(spark, R.bag_label(f"{size}D"))[0] == want


def test_peak_months_and_vector_check(spark):
    v = R.vector_literal([1.6, 1.2, 0.5, 0.4, 0.5, 0.6, 0.7, 1.0, 1.5, 1.8, 1.6, 1.19])
    assert one(spark, R.peak_months(v))[0] == [1, 2, 9, 10, 11]
    ok, short, negative, missing = (
        R.vector_literal([1.0] * 12),
        R.vector_literal([1.0] * 11),
        R.vector_literal([1.0] * 11 + [-0.1]),
        "cast(null as array<double>)",
    )
    assert list(one(spark, *[R.vector_ok(x) for x in (ok, short, negative, missing)])) == [
        True, False, False, False,
    ]
    assert one(spark, R.flat_vector())[0] == [1.0] * 12


@pytest.mark.parametrize(
    "department, category, subcategory, want",
    [
        ("Frozen", "Ice Cream & Desserts", "Ice Cream Tubs", "ice_cream"),
        ("Frozen", "Ice Cream & Desserts", "Frozen Desserts", "ice_cream"),
        ("Pantry", "Soup", "Tins", "soup"),
        ("Meat & Seafood", "Pork & Smallgoods", "Bacon", "barbecue"),
        ("Meat & Seafood", "Pork & Smallgoods", "bacon", None),
        ("Bakery", "Savoury Baked", "Sausage Rolls", "barbecue"),
        ("Beverages", "Hot Drinks", "Hot Chocolate", "easter"),
        ("Alcohol", "Wine", "Sparkling", "christmas"),
        ("Beverages", "Juice & Water", "Sparkling Water", None),
    ],
)
def test_season(spark, department, category, subcategory, want):
    assert one(spark, R.season_name(f"'{department}'", f"'{category}'", f"'{subcategory}'"))[0] == want


@pytest.mark.parametrize(
    "department, subcategory, unit, sizes",
    [
        ("Beverages", "Fruit Juice", "L", values.LITRE_PACKS),
        ("Beverages", "fruit juice", "each", (1.0,)),
        ("Alcohol", "Red Wine", "mL", (700.0,)),
        ("Dairy", "Full Cream", "each", (1.0,)),
        ("Meat & Seafood", "Mince", "kg", values.MEAT_PACKS),
        ("Household", "Laundry", "mL", values.CARE_PACKS),
        ("Pantry", "Rice", "g", values.PANTRY_PACKS),
        ("Frozen", "Pizza", "g", values.FROZEN_PACKS),
        ("Bakery", "Rolls", "each", (1.0,)),
    ],
)
def test_unit_and_pack(spark, department, subcategory, unit, sizes):
    rows = spark.range(200).selectExpr("id / 200D as u")
    got_unit, got_pack = R.unit_and_pack(f"'{department}'", f"'{subcategory}'", "u")
    rows = rows.selectExpr(f"{got_unit} as a", f"{got_pack} as b").distinct().collect()
    assert {r.a for r in rows} == {unit}
    assert {r.b for r in rows} == set(sizes)


def test_names_and_keys(spark):
    got = one(
        spark,
        R.product_name("'Brand'", "'Rice'", "'500g'"),
        R.product_name("'Brand'", "'Rice'", "''"),
        R.product_name("''", "'Rice'", "''"),
        R.format_key("P", "42", 6),
        R.format_key("P", "1234567", 6),
        R.format_key("", "3000001", 13),
        R.format_key("SUP", "7", 4),
    )
    assert list(got) == [
        "Brand Rice 500g", "Brand Rice", "Rice", "P000042", "P1234567", "0000003000001", "SUP0007",
    ]


def product(**over):
    row = {
        "product_id": "P000001", "cost_price_aud": 1.0, "retail_price_aud": 2.0, "pack_size": 1.0,
        "shelf_life_days": None, "peak_season_months": None,
    }
    return {**row, **over}


PRODUCT = (
    "product_id string, cost_price_aud double, retail_price_aud double, pack_size double,"
    " shelf_life_days double, peak_season_months array<bigint>"
)


def test_silver_casts_round_half_up(spark):
    costs = [1.005, 2.675, -0.125, float("nan")]
    df = spark.createDataFrame([product(cost_price_aud=c) for c in costs], PRODUCT)
    got = [r.cost_price_aud for r in to_silver(df).collect()]
    assert got == [Decimal("1.01"), Decimal("2.68"), Decimal("-0.13"), None]


def test_gold_flags(spark):
    rows = [
        product(peak_season_months=None, shelf_life_days=None),
        product(peak_season_months=[], shelf_life_days=7.0),
        product(peak_season_months=[1], shelf_life_days=7.0),
    ]
    df = to_gold(to_silver(spark.createDataFrame(rows, PRODUCT)))
    got = [(r.is_seasonal, r.is_perishable) for r in df.collect()]
    assert got == [(False, False), (False, True), (True, True)]
    assert "_silver_loaded_at_utc" not in df.columns
