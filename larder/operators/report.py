"""Report queries: one grouped aggregate with filters and an order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_query(
    model: DataFrame,
    group_by: Sequence[str],
    aggregates: Mapping[str, str],
    order_by: Sequence[str] = (),
    filters: Sequence[str] = (),
    subtotals: bool = False,
) -> DataFrame:
    """``aggregates`` maps result names to SQL aggregates; ``order_by`` takes ``name`` or
    ``-name`` for descending. Filters apply before grouping, so they reach the scan. With
    ``subtotals`` outer groups get their own rows, marked by ``level`` (0 = finest)."""
    for f in filters:
        model = model.filter(f)
    aggs = [F.expr(sql).alias(name) for name, sql in aggregates.items()]
    if subtotals:
        out = model.rollup(*group_by).agg(F.grouping_id().cast("int").alias("level"), *aggs)
    else:
        out = model.groupBy(*group_by).agg(*aggs)
    if order_by:
        out = out.orderBy(*[F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order_by])
    return out


AVERAGE_PRICE = {
    "avg_retail_price": "round(cast(avg(retail_price_aud) as double), 4)",
}
PRODUCT_COUNT = {"n_products": "count(product_id)"}


def average_price_by_department(model: DataFrame, filters: Sequence[str] = ()) -> DataFrame:
    """Bar chart: average retail price per department, highest first."""
    order = ["-avg_retail_price", "department"]
    return report_query(model, ["department"], AVERAGE_PRICE, order, filters)


def product_treemap(model: DataFrame, filters: Sequence[str] = ()) -> DataFrame:
    """Treemap: products per department and category."""
    return report_query(model, ["department", "category"], PRODUCT_COUNT, filters=filters)


def product_treemap_nested(model: DataFrame) -> DataFrame:
    """Treemap boxes of both levels and the whole."""
    return report_query(model, ["department", "category"], PRODUCT_COUNT, subtotals=True)
