"""Product rows derived from a ``part`` table: the landing data of the layer queries.

Department and subcategory follow from the part's size and key, money is decimal from the start.
One pass over ``part`` with two broadcast joins; columns nobody selects are pruned away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder import values
from larder.functions import draws as D
from larder.functions import rules as R
from larder.lookups import Lookups
from larder.operators.enrich import lookup, with_gst_flag, with_perishability
from larder.plans.builder import RAW_COLUMNS

WOBBLE_SEED = 7


def subcategory_rules(lookups: Lookups) -> DataFrame:
    """All rules that depend on the subcategory only, one row each."""
    if "subcategory_rules" in lookups.derived:
        return lookups.derived["subcategory_rules"]
    df = with_gst_flag(lookups.table("taxonomy"), lookups.table("gst_free"))
    df = with_perishability(df, lookups.table("shelf_life"))
    season = R.season_name("department", "category", "subcategory")
    df = df.selectExpr(
        "dept_no", "flat_no", "category", "subcategory", "gst_applicable",
        "shelf_life_days as cat_life", "wastage_rate_baseline as cat_waste", f"{season} as season",
    )
    lookups.derived["subcategory_rules"] = df
    return df


def part_products(part: DataFrame, lookups: Lookups) -> DataFrame:
    """``part`` with the product columns; money columns ``cost``, ``charm``, ``retail`` as decimal."""
    wobble = R.wobble_draws("wobble")
    rows = D.with_draws(
        part.selectExpr("p_partkey as k", "p_size", "p_brand", "p_size % 10 as dept_no"),
        WOBBLE_SEED, "k", wobble,
    )
    dept = lookups.table("department").select("dept_no", "department", "margin", "n_subcategories")
    rows = rows.join(dept, "dept_no")
    rows = lookup(
        rows,
        lookups.hint(subcategory_rules(lookups), "taxonomy", "gst_free", "shelf_life"),
        {"dept_no": "dept_no", "flat_no": "k % n_subcategories"},
    )
    endings = " ".join(f"when {i} then {e}BD" for i, e in enumerate(values.PRICE_ENDINGS))
    rows = rows.selectExpr(
        "*",
        "cast(0.30BD + 0.40BD * p_size + 0.01BD * (k % 100) as decimal(10,2)) as cost",
        f"cast(case k % 4 {endings} end as decimal(10,2)) as ending",
        "p_brand as brand",
        "k % 5 = 0 and department <> 'Fresh Produce' as is_private_label",
        # Fresh goods are not in the category table; they carry values of their own.
        "if(department = 'Fresh Produce', cast(k % 28 + 3 as double), cat_life) as shelf_life_days",
        "if(department = 'Fresh Produce', 0.06D, cat_waste) as wastage_rate_baseline",
    )
    rows = rows.selectExpr("*", "cost * (1 + margin) as markup")
    rows = rows.selectExpr("*", f"{R.charm_price('markup', 'ending')} as charm")
    rows = rows.selectExpr("*", f"{R.retail_above_cost('charm', 'cost')} as retail")
    vector = R.season_vector("season", R.wobble_vector([f"u_{n}" for n in wobble]))
    return rows.selectExpr("*", f"{vector} as seasonality_vector")


def landing_products(part: DataFrame, lookups: Lookups) -> DataFrame:
    """The 18 raw columns with doubles, as a landed file holds them."""
    fresh = "department = 'Fresh Produce'"
    peaks = R.peak_months("seasonality_vector")
    return part_products(part, lookups).selectExpr(
        f"{R.format_key('P', 'k', 6)} as product_id",
        f"{R.format_key('', f'k + if({fresh}, 2000000, 3000000)', 13)} as sku",
        "concat_ws(' ', brand, subcategory) as name",
        "department", "category", "subcategory", "brand", "is_private_label",
        "case when department = 'Pantry' then 'g' else 'each' end as unit_of_measure",
        "case when department = 'Pantry' then 375D else 1D end as pack_size",
        "cast(cost as double) as cost_price_aud",
        "cast(retail as double) as retail_price_aud",
        "gst_applicable", "shelf_life_days",
        f"if({fresh} or season is not null, {peaks}, null) as peak_season_months",
        "seasonality_vector", "wastage_rate_baseline",
        f"{R.format_key('SUP', 'k % 60 + 1', 4)} as supplier_id",
    ).select(*RAW_COLUMNS)


def read_part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_products(spark.read.parquet(f"{sf_dir}/part.parquet"), Lookups.builtin(spark))


def read_landing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_products(spark.read.parquet(f"{sf_dir}/part.parquet"), Lookups.builtin(spark))
