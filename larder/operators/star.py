"""Star-schema aggregates over facts and dimensions. Money is exact decimal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVENUE = (
    "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"
)


QUANTITY = "cast(l_quantity as decimal(12,2))"

# Facts join their dimensions as they are and are reduced to the report's few groups in the same
# stage. Small dimensions are broadcast by Spark, so only group totals are shuffled. A dimension too
# large for that is joined by shuffle, where adaptive execution splits the partitions of hot keys;
# reducing facts to (part, supplier, ...) first would shuffle them once more and merge next to nothing.


def _totals(groups):
    return groups.agg(
        F.count("*").alias("n_lines"),
        F.expr(f"sum({QUANTITY})").cast("decimal(18,2)").alias("quantity"),
        F.expr(f"sum({REVENUE})").cast("decimal(22,4)").alias("revenue"),
    )


def star_join_agg(
    lines: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame
) -> DataFrame:
    """Quantity and revenue by supplier nation, part type and ship year."""
    facts = (
        lines.withColumn("ship_year", F.year("l_shipdate"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return _totals(facts.groupBy("n_name", "p_type", "ship_year"))


def month_brand_cube(lines: DataFrame, part: DataFrame) -> DataFrame:
    """Pre-aggregated measure table by month and brand with all subtotals (``level`` 0 = finest).

    The subtotals are built from the month-brand totals, so each line is aggregated once and not
    once per grouping set.
    """
    facts = lines.withColumn("number", F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1)
    facts = facts.join(part, F.col("l_partkey") == F.col("p_partkey"))
    totals = _totals(facts.groupBy("number", "p_brand"))
    year, month = F.expr("cast(number div 12 as string)"), (F.col("number") % 12 + 1).cast("string")
    totals = totals.withColumn("month", F.concat(year, F.lit("-"), F.lpad(month, 2, "0")))
    return totals.cube("month", "p_brand").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("n_lines").alias("n_lines"),
        F.sum("quantity").cast("decimal(18,2)").alias("quantity"),
        F.sum("revenue").cast("decimal(22,4)").alias("revenue"),
    )
