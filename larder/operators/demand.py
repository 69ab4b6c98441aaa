"""Seasonal weights, expected wastage and the demand forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QTY = "cast(l_quantity as decimal(12,2))"
SEASON_WEEKS = 52
HORIZON_WEEKS = 4
#: Sales dated outside these days count as undated, which bounds the weeks of a product.
FIRST_DAY, LAST_DAY = "1990-01-01", "2049-12-31"


def monthly_sales(lines: DataFrame) -> DataFrame:
    """Quantity per product and month of the year: at most twelve rows per product meet what is joined
    next, and a hot product shrinks to those in every task before the shuffle."""
    facts = lines.selectExpr("l_partkey", "month(l_shipdate) as month", f"{QTY} as qty")
    return facts.groupBy("l_partkey", "month").agg(F.sum("qty").alias("qty"))


def seasonal_weighted_sales(
    lines: DataFrame, products: DataFrame, key: str = "k", vector: str = "seasonality_vector"
) -> DataFrame:
    """Quantity and season-weighted quantity by department and month."""
    sold = monthly_sales(lines)
    sold = sold.join(products.select(key, "department", vector), F.expr(f"l_partkey = {key}"))
    weight = f"cast(element_at({vector}, month) as decimal(4,2))"
    return sold.groupBy("department", "month").agg(
        F.sum("qty").cast("decimal(18,2)").alias("quantity"),
        F.expr(f"sum(qty * {weight})").cast("decimal(20,4)").alias("weighted_quantity"),
    )


def expected_wastage(
    lines: DataFrame, products: DataFrame, key: str = "k", vector: str = "seasonality_vector"
) -> DataFrame:
    """Quantity sold and quantity expected to be wasted by category: each month's sales times the
    product's wastage rate times its season weight of that month (1 without one). Products without a
    wastage rate waste nothing.
    """
    rate = "coalesce(cast(wastage_rate_baseline as decimal(4,2)), 0)"
    prods = products.selectExpr(key, "department", "category", f"{rate} as rate", vector)
    weight = f"coalesce(cast(element_at({vector}, month) as decimal(4,2)), 1)"
    return (
        monthly_sales(lines).join(prods, F.col("l_partkey") == F.col(key))
        .groupBy("department", "category")
        .agg(
            F.sum("qty").cast("decimal(18,2)").alias("quantity"),
            F.expr(f"sum(qty * rate * {weight})").cast("decimal(22,6)").alias("expected_wastage"),
        )
    )


def weekly_demand(lines: DataFrame) -> DataFrame:
    """Quantity per product and week; weeks start on Monday and are numbered since 1970-01-05.

    Sales without a date, or dated outside ``FIRST_DAY`` to ``LAST_DAY``, have the week NULL.
    """
    day = "cast(l_shipdate as date)"
    known = f"{day} between date '{FIRST_DAY}' and date '{LAST_DAY}'"
    week = f"if({known}, cast(floor(datediff({day}, date '1970-01-05') / 7) as int), null)"
    return (
        lines.selectExpr("l_partkey", f"{week} as week", f"{QTY} as qty")
        .groupBy("l_partkey", "week")
        .agg(F.sum("qty").alias("qty"))
    )


def weekly_arrays(weekly: DataFrame) -> DataFrame:
    """Per product: the first week with sales and hundredths sold in each week from there to the last one.

    Weeks without sales hold 0. An array has one entry per week between ``FIRST_DAY`` and ``LAST_DAY`` at most; undated
    sales take no part (:func:`undated_sales`).
    """
    dated = weekly.where("week is not null").selectExpr("l_partkey", "week", "cast(coalesce(qty, 0) * 100 as bigint) as c")
    sales = dated.groupBy("l_partkey").agg(F.sort_array(F.collect_list(F.struct("week", "c"))).alias("e"))
    # A week with sales is followed by zeros up to the next one.
    sold = "flatten(transform(e, (x, i) -> concat(array(x.c), array_repeat(0L, coalesce(get(e, i + 1).week - x.week - 1, 0)))))"
    return sales.selectExpr("l_partkey", "e[0].week as first_week", f"{sold} as sold")


def undated_sales(weekly: DataFrame) -> DataFrame:
    """Quantity per product that belongs to no week."""
    return weekly.where("week is null").select("l_partkey", F.col("qty").cast("decimal(18,2)").alias("demand"))


def seasonal_naive_forecast(
    weekly: DataFrame, season: int = SEASON_WEEKS, horizon: int = HORIZON_WEEKS
) -> DataFrame:
    """Per product and week, ``horizon`` weeks ahead: demand (NULL for weeks to come), the same week one
    season earlier (NULL before the first sale) and the mean of the four weeks before; for weeks to come
    that of the last four weeks known. Weeks without sales count as zero. Undated sales are reported in a
    row of their own with the week NULL and no forecast.

    A product's weeks are one array with lags by place, so a product is one row until its weeks become rows. The lags are looked
    up after that, in generated code and without an object per week. A caller who wants fresh goods alone filters ``weekly`` by their keys.
    """
    before = " + ".join(f"coalesce(get(sold, least(i, n) - {j}), 0L)" for j in (1, 2, 3, 4))
    grid = weekly_arrays(weekly).selectExpr("l_partkey", "first_week", "sold", "size(sold) as n")
    grid = grid.selectExpr("*", f"explode(sequence(0, n + {horizon} - 1)) as i").selectExpr(
        "l_partkey", "first_week + i as week", "get(sold, i) as d", f"get(sold, i - {season}) as p", f"{before} as m"
    )
    cents = "cast(cast({} as decimal(18,0)) * {} as decimal(18,{}))"
    grid = grid.selectExpr(
        "l_partkey",
        "week",
        f"{cents.format('d', '0.01', 2)} as demand",
        f"{cents.format('p', '0.01', 2)} as naive_forecast",
        f"{cents.format('m', '0.0025', 4)} as mean_4_weeks",
    )
    return grid.unionByName(undated_sales(weekly).withColumn("week", F.lit(None).cast("int")), allowMissingColumns=True)
