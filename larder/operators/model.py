"""The reporting model: which gold columns it shows and how each is summed by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: model column | gold column | default summary --------------------------------
MODEL_TEXT = """
product_id            | product_id            | none
sku                   | sku                   | none
name                  | name                  | none
department            | department            | none
category              | category              | none
subcategory           | subcategory           | none
brand                 | brand                 | none
is_private_label      | is_private_label      | none
unit_of_measure       | unit_of_measure       | none
pack_size             | pack_size             | sum
cost_price_aud        | cost_price_aud        | sum
retail_price_aud      | retail_price_aud      | sum
gst_applicable        | gst_applicable        | none
shelf_life_days       | shelf_life_days       | sum
wastage_rate_baseline | wastage_rate_baseline | sum
supplier_id           | supplier_id           | none
is_perishable         | is_perishable         | none
is_seasonal           | is_seasonal           | none
price_tier            | price_tier            | none
margin_pct            | margin_pct            | sum
"""


def model_columns() -> list[tuple[str, str, str]]:
    """(model column, gold column, default summary)"""
    rows = (line.split("|") for line in MODEL_TEXT.strip().splitlines())
    return [tuple(cell.strip() for cell in row) for row in rows]


def model_projection(gold: DataFrame) -> DataFrame:
    """The model's columns by their model names; arrays stay out."""
    return gold.selectExpr(*[f"{source} as {name}" for name, source, _ in model_columns()])


def create_model_view(spark: SparkSession, table: str, name: str) -> DataFrame:
    """The model as a catalogue view over the stored gold table; it outlives the session, nothing is copied."""
    columns = ", ".join(f"{source} AS {own}" for own, source, _ in model_columns())
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {table}")
    return spark.table(name)


def default_sums(model: DataFrame, *group_by: str) -> DataFrame:
    """Each summable column summed per group, plus the margin that the sums themselves give."""
    sums = [
        f"sum(cast({name} as decimal(18,4))) as sum_{name}"
        for name, _, summary in model_columns()
        if summary == "sum"
    ]
    margin = (
        "cast(round(cast(try_divide(sum(retail_price_aud) - sum(cost_price_aud),"
        " sum(retail_price_aud)) * 100 as double), 4) as double) as overall_margin_pct"
    )
    return model.groupBy(*group_by).agg(*[F.expr(e) for e in (*sums, margin)])
