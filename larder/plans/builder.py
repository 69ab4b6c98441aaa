"""Building product tables: one narrow pass over row numbers.

Every value of a row follows from (seed, row number), so tasks are independent, can be retried, and
give the same table for any number of partitions. Row numbers alone are shuffled, to find their
department; from there on the row stream meets broadcast lookups only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import values
from larder.functions import draws as D
from larder.functions import rules as R
from larder.lookups import Lookups
from larder.operators.allocate import allocate, expand
from larder.operators.enrich import lookup, with_gst_flag, with_perishability

RAW_COLUMNS = (
    "product_id", "sku", "name", "department", "category", "subcategory", "brand",
    "is_private_label", "unit_of_measure", "pack_size", "cost_price_aud", "retail_price_aud",
    "gst_applicable", "shelf_life_days", "peak_season_months", "seasonality_vector",
    "wastage_rate_baseline", "supplier_id",
)

FRESH = "Fresh Produce"
MANY_PARTITIONS = 100_000_000
SKU_BASE_FRESH = 2_000_000
SKU_BASE_OTHER = 3_000_000
DRAWS = (
    "spec", "category", "subcategory", "pack", "fresh_pack", "private_label", "cost", "fresh_cost",
    "jitter", "ending", "brand", "template", "supplier",
)


def supplier_pools(
    keys: DataFrame, key: str = "cat_id", pool: str | int = values.SUPPLIER_POOL, seed: int = 0
) -> DataFrame:
    """1 to 3 different supplier numbers per key as ``suppliers``."""
    names = ("supplier1", "supplier2", "supplier3", "suppliers")
    df = D.with_draws(keys, seed, key, names, prefix="_u_")
    count = f"{D.uniform_int('_u_suppliers', 3)} + 1"
    df = D.with_distinct_picks(
        df, ("_u_supplier1", "_u_supplier2", "_u_supplier3"), pool, count, "suppliers"
    )
    return df.drop(*[f"_u_{n}" for n in names])


def category_rules(lookups: Lookups) -> DataFrame:
    """Per category: subcategories, suppliers, GST flag, shelf life and wastage."""
    df = with_gst_flag(supplier_pools(lookups.table("category")), lookups.table("gst_free"))
    df = with_perishability(df, lookups.table("shelf_life"))
    return df.selectExpr(
        "dept_no", "cat_no", "category", "subcategories", "suppliers", "gst_applicable",
        "shelf_life_days as cat_life", "wastage_rate_baseline as cat_waste",
    )


def fresh_specs(lookups: Lookups) -> DataFrame:
    """Curated fresh goods with their place in the taxonomy and a complete season vector."""
    cats = lookups.table("category").filter(F.col("department") == FRESH)
    cats = cats.selectExpr("category as _cat", "cat_no as spec_cat_no")
    wobble = R.wobble_draws("wobble")
    df = D.with_draws(lookups.table("fresh"), 0, "spec_no", wobble)
    vector = R.wobble_vector([f"u_{n}" for n in wobble])
    return df.join(cats, F.col("category") == F.col("_cat")).selectExpr(
        "spec_no", "spec_cat_no", "name as spec_name", "subcategory as spec_sub",
        "unit_of_measure as spec_unit", "pack_size as spec_pack", "cost as spec_cost",
        "shelf_life_days as spec_life", "wastage_rate as spec_waste",
        f"coalesce(months, {vector}) as spec_vector",
    )


def fresh_cost(pack: str, spec_cost: str, u: str) -> str:
    """Cost of a curated item in another pack: cost x pack x U(0.9, 1.1), at least 0.50."""
    raw = f"cast({spec_cost} as double) * {pack} * {D.uniform_real(u, 0.9, 1.1)}"
    return f"greatest({D.to_cents(raw)}, cast(0.50BD as decimal(10,2)))"


def products_for(
    ids: DataFrame, number: str, total: int | Column, seed: int, lookups: Lookups
) -> DataFrame:
    """The 18-column product table, one row per row of ``ids``; ``number`` runs from 1 to total."""
    dept = lookups.table("department")
    n_specs = lookups.rows("fresh")
    allocation = allocate(dept, total)
    wobble = R.wobble_draws("wobble")

    def by_kind(curated: str, variant: str, other: str) -> str:
        return f"case when is_curated then {curated} when is_fresh then {variant} else {other} end"

    # One generated function for the whole row would exceed the 8000 bytecodes the JVM compiles to
    # machine code. The array steps (wobble, peak months) end a generated stage, which keeps each
    # stage small; expressions between them are spread over the joins.
    rows = expand(ids.selectExpr(f"cast({number} as bigint) as idx"), "idx", allocation)
    rows = D.with_draws(rows, seed, "idx", (*DRAWS, *wobble))
    rows = rows.selectExpr(
        *[c for c in rows.columns if c not in {f"u_{n}" for n in wobble}],
        f"{R.wobble_vector([f'u_{n}' for n in wobble])} as wobble",
    )
    dept = dept.selectExpr(
        "dept_no", "department", "margin", "cost_low", "cost_mode", "cost_high",
        "private_label_rate", "brands", "n_categories", f"department = '{FRESH}' as is_fresh",
    )
    rows = rows.join(dept, "dept_no")

    # Rows that only need their department.
    curated = f"(is_fresh and in_group <= {n_specs})"
    rows = rows.selectExpr(
        "idx", "dept_no", "department", "is_fresh", "margin", "wobble", "n_categories",
        "u_category", "u_subcategory", "u_pack", "u_fresh_pack", "u_fresh_cost", "u_jitter",
        "u_ending", "u_template", "u_supplier",
        f"{curated} as is_curated",
        f"case when {curated} then cast(in_group as int) - 1"
        f" when is_fresh then {D.uniform_int('u_spec', n_specs)} end as at_spec",
        "not is_fresh and u_private_label < private_label_rate as is_private_label",
        f"if(is_fresh, {R.fresh_brand('u_brand', 'private_label_rate', 'brands')},"
        f" {R.brand_pick('u_private_label < private_label_rate', 'u_brand', 'brands')}) as brand",
        f"{D.to_cents(D.triangular('u_cost', 'cost_low', 'cost_mode', 'cost_high'))} as drawn_cost",
    )
    rows = _stage_end(rows)
    specs = lookups.hint(fresh_specs(lookups), "fresh", "category")
    rows = lookup(rows, specs, {"spec_no": "at_spec"}, "left")

    # Prices and the category.
    bag = f"if(is_fresh and not is_curated, {D.choice_of('u_fresh_pack', values.FRESH_PACKS)}, null)"
    rows = rows.selectExpr("*", f"{bag} as bag")
    rows = rows.selectExpr(
        "*",
        f"coalesce(spec_cat_no, {D.uniform_int('u_category', 'n_categories')}) as at_category",
        f"{by_kind('spec_cost', fresh_cost('bag', 'spec_cost', 'u_fresh_cost'), 'drawn_cost')}"
        " as cost",
        f"if(is_fresh, {D.uniform_real('u_jitter', 0.95, 1.05)},"
        f" {D.uniform_real('u_jitter', 0.97, 1.03)}) as jitter",
        f"{R.price_ending('u_ending')} as ending",
    )
    rows = rows.selectExpr("*", f"{R.markup_price('cost', 'margin', 'jitter')} as markup")
    rows = rows.selectExpr("*", f"{R.charm_price('markup', 'ending')} as charm")
    rows = rows.selectExpr("*", f"{R.retail_above_cost('charm', 'cost')} as retail")
    rows = _stage_end(rows)
    cats = lookups.hint(category_rules(lookups), "category", "gst_free", "shelf_life")
    rows = lookup(rows, cats, {"dept_no": "dept_no", "cat_no": "at_category"})

    # Subcategory, pack and season.
    sub = D.choice("u_subcategory", "subcategories")
    rows = rows.selectExpr("*", f"if(is_fresh, spec_sub, {sub}) as subcategory")
    unit, pack = R.unit_and_pack("department", "subcategory", "u_pack")
    rows = rows.selectExpr(
        "*",
        f"{by_kind('spec_unit', _quoted('kg'), unit)} as unit_of_measure",
        f"{by_kind('spec_pack', 'bag', pack)} as pack_size",
        f"if(is_fresh, null, {R.season_name('department', 'category', 'subcategory')}) as season",
    )
    vector = f"if(is_fresh, spec_vector, {R.season_vector('season', 'wobble')})"
    rows = rows.selectExpr("*", f"{vector} as seasonality_vector")
    rows = _stage_end(rows)
    rows = lookup(rows, lookups.table("name_template"), {"subcategory": "subcategory"}, "left")

    base = f"coalesce({D.choice('u_template', 'templates')}, subcategory)"
    variant_name = f"concat_ws(' ', spec_name, {R.bag_label('bag')})"
    other_name = R.product_name("brand", base, R.pack_label("unit_of_measure", "pack_size"))
    sku = f"idx + if(is_fresh, {SKU_BASE_FRESH}L, {SKU_BASE_OTHER}L)"
    return rows.selectExpr(
        f"{R.format_key('P', 'idx', 6)} as product_id",
        f"{R.format_key('', sku, 13)} as sku",
        f"{by_kind('spec_name', variant_name, other_name)} as name",
        "department", "category", "subcategory", "brand", "is_private_label",
        "unit_of_measure", "pack_size",
        "cast(cost as double) as cost_price_aud",
        "cast(retail as double) as retail_price_aud",
        "gst_applicable",
        "if(is_fresh, spec_life, cat_life) as shelf_life_days",
        # Fresh goods keep an empty list, other products have NULL when no month peaks.
        f"if(is_fresh or season is not null, {R.peak_months('seasonality_vector')}, null)"
        " as peak_season_months",
        "seasonality_vector",
        "if(is_fresh, spec_waste, cat_waste) as wastage_rate_baseline",
        f"{R.format_key('SUP', D.choice('u_supplier', 'suppliers'), 4)} as supplier_id",
    )


def _stage_end(df: DataFrame) -> DataFrame:
    """End the generated stage here; the partitions stay as they are (no shuffle, no merging)."""
    return df.coalesce(MANY_PARTITIONS)


def _quoted(s: str) -> str:
    return f"'{s}'"


def build_products(
    spark: SparkSession,
    n: int = 2000,
    seed: int = 42,
    lookups: Lookups | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``n`` products, in no particular order."""
    ids = spark.range(1, n + 1, numPartitions=partitions)
    return products_for(ids, "id", n, seed, lookups or Lookups.builtin(spark))
