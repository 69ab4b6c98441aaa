"""Report and model queries over the gold columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.catalog import query
from larder.catalog.check_sql import GOLD
from larder.operators import layers as L
from larder.operators import model as M
from larder.operators import report as RP
from larder.plans.part_products import read_landing_products


def _model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.model_projection(_gold(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.to_gold(L.to_silver(read_landing_products(spark, sf_dir)))


@query(
    "layer_stats",
    f"""with {GOLD} select count(*) n_rows, count_if(is_perishable)::bigint n_perishable,
        count_if(is_seasonal)::bigint n_seasonal from gold""",
)
def layer_stats(spark, sf_dir):
    return L.layer_stats(_gold(spark, sf_dir))


@query(
    "report_avg_price_by_department",
    f"""with {GOLD} select department, round(avg(retail_price_aud)::double, 4) avg_retail_price
        from gold group by department order by 2 desc, 1""",
)
def report_avg_price_by_department(spark, sf_dir):
    return RP.average_price_by_department(_model(spark, sf_dir))


@query(
    "report_treemap",
    f"""with {GOLD} select department, category, count(product_id) n_products
        from gold group by department, category""",
)
def report_treemap(spark, sf_dir):
    return RP.product_treemap(_model(spark, sf_dir))


@query(
    "report_treemap_rollup",
    f"""with {GOLD} select department, category, grouping(department, category)::integer as level,
        count(product_id) n_products from gold group by rollup (department, category)""",
)
def report_treemap_rollup(spark, sf_dir):
    return RP.product_treemap_nested(_model(spark, sf_dir))


_SUMS = ", ".join(
    f"cast(sum(cast({n} as decimal(18,4))) as decimal(28,4)) sum_{n}"
    for n, _, s in M.model_columns()
    if s == "sum"
)


@query(
    "model_default_sums",
    f"""with {GOLD} select department, {_SUMS},
        round(((sum(retail_price_aud) - sum(cost_price_aud))::double
          / sum(retail_price_aud)::double * 100), 4) overall_margin_pct
        from gold group by department""",
)
def model_default_sums(spark, sf_dir):
    return M.default_sums(_model(spark, sf_dir), "department")


@query(
    "report_cross_filter",
    f"""with {GOLD} select category, count(product_id) n_products,
        round(avg(retail_price_aud)::double, 4) avg_retail_price
        from gold where department = 'Dairy' group by category order by category""",
)
def report_cross_filter(spark, sf_dir):
    aggs = {**RP.PRODUCT_COUNT, **RP.AVERAGE_PRICE}
    picked = ["department = 'Dairy'"]
    return RP.report_query(_model(spark, sf_dir), ["category"], aggs, ["category"], picked)
