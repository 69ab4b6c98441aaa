"""Totals by month and brand that merge: sums, and distinct orders as a sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.star import QUANTITY, REVENUE

#: 2^12 registers: a standard error of 1.6 % of a distinct count.
SKETCH_BITS = 12


def month_brand_deltas(lines: DataFrame, part: DataFrame) -> DataFrame:
    """What a batch of lines adds. Lines without a date or a known part have totals of their own (NULL)."""
    brands = part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    month = F.date_format("l_shipdate", "yyyy-MM")
    facts = lines.join(brands, "l_partkey", "left").withColumns({"ship_year": F.year("l_shipdate"), "ship_month": month})
    return facts.groupBy("ship_year", "ship_month", "p_brand").agg(
        F.count("*").alias("n_lines"),
        F.expr(f"sum({QUANTITY})").cast("decimal(18,2)").alias("quantity"),
        F.expr(f"sum({REVENUE})").cast("decimal(22,4)").alias("revenue"),
        F.hll_sketch_agg("l_orderkey", F.lit(SKETCH_BITS)).alias("orders"),
    )
