"""Lookup joins that add rule columns. All lookups are small and broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import values


def lookup(df: DataFrame, table: DataFrame, on: dict[str, str], how: str = "inner") -> DataFrame:
    """Equi-join a lookup: ``on`` maps lookup columns to expressions over ``df``."""
    keyed = table.selectExpr(*[f"{c} as _k_{c}" if c in on else c for c in table.columns])
    cond = F.expr(" and ".join(f"_k_{c} = {expr}" for c, expr in on.items()))
    return df.join(keyed, cond, how).drop(*[f"_k_{c}" for c in on])


def with_gst_flag(df: DataFrame, gst_free: DataFrame, out: str = "gst_applicable") -> DataFrame:
    """False for departments and (department, category) pairs listed as GST-free, else true.

    ``gst_free`` lists each entry once; a NULL category stands for the whole department.
    """
    whole = gst_free.filter("category is null").selectExpr("department", "true as _dept_free")
    pairs = gst_free.filter("category is not null").selectExpr(
        "department", "category", "true as _pair_free"
    )
    df = lookup(df, whole, {"department": "department"}, "left")
    on = {"department": "department", "category": "category"}
    df = lookup(df, pairs, on, "left")
    free = "coalesce(_dept_free, _pair_free, false)"
    return df.selectExpr("*", f"not {free} as {out}").drop("_dept_free", "_pair_free")


def with_perishability(
    df: DataFrame, shelf: DataFrame, departments=values.PERISHABLE_DEPARTMENTS
) -> DataFrame:
    """Shelf life and wastage by category, only in perishable departments, else NULL."""
    known = shelf.selectExpr("category", "shelf_life_days as _life", "wastage_rate as _waste")
    kinds = ", ".join("'" + d.replace("'", "''") + "'" for d in departments)
    return (
        lookup(df, known, {"category": "category"}, "left")
        .selectExpr(
            "*",
            f"if(department in ({kinds}), _life, null) as shelf_life_days",
            f"if(department in ({kinds}), _waste, null) as wastage_rate_baseline",
        )
        .drop("_life", "_waste")
    )
