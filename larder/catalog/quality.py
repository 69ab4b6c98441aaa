"""Quality queries over product rows and the fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import values
from larder.catalog import query
from larder.catalog.check_sql import PARTS, SILVER
from larder.lookups import Lookups
from larder.operators import layers as L
from larder.operators import quality as Q
from larder.plans.part_products import read_landing_products, read_part_products

LINE_KEY = ("l_orderkey", "l_linenumber")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.to_silver(read_landing_products(spark, sf_dir))


# Some rows are spoiled, each column at other rows, so that the rules find something.
_SPOILED = {
    "retail_price_aud": ("{row} % 31 = 0", "cast(retail_price_aud + 0.01 as decimal(10,2))"),
    "supplier_id": ("{row} % 37 = 0", "replace(supplier_id, 'SUP', 'S')"),
    "shelf_life_days": ("{row} % 41 = 0", "cast(0 as double)"),
    "wastage_rate_baseline": ("{row} % 43 = 0", "cast(1.5 as double)"),
    "gst_applicable": ("{row} % 47 = 0", "not gst_applicable"),
}
_ROW_SQL = "substr(product_id, 2)::bigint"
SPOILED_SQL = f"{SILVER}, spoiled as (select * replace (" + ", ".join(
    f"case when {when.format(row=_ROW_SQL)} then {to} else {c} end as {c}"
    for c, (when, to) in _SPOILED.items()
) + ") from silver)"


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = "cast(substr(product_id, 2) as bigint)"
    return _silver(spark, sf_dir).withColumns(
        {c: F.expr(f"if({when.format(row=row)}, {to}, {c})") for c, (when, to) in _SPOILED.items()}
    )


def _rule_sql(rule: str, n: str, bad: str) -> str:
    quoted = rule.replace("'", "''")
    return (
        f"select '{quoted}' as rule, ({n})::bigint n_rows, ({bad})::bigint n_failed,"
        f" ({bad}) = 0 passed"
    )


def _row_sql(rule: str, bad: str, when: str = "true", source: str = "silver") -> str:
    return (
        _rule_sql(rule, f"count_if({when})", f"count_if(({when}) and ({bad}))") + f" from {source}"
    )


def _named(*names: str) -> tuple[Q.RowRule, ...]:
    return tuple(r for r in Q.product_rules() if r.name in names)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _only(report: DataFrame, *rules: str) -> DataFrame:
    return report.filter(F.col("rule").isin(*rules))


@query("dq_row_count", _rule_sql("row_count", "count(*)", "0") + " from lineitem")
def dq_row_count(spark, sf_dir):
    return _only(Q.check_counts(_lines(spark, sf_dir), Q.KeyRule(LINE_KEY)), "row_count")


# Keys equal to the line number are blanked first.
_BLANKED = "(select nullif(l_orderkey % 10, l_linenumber) as k, l_linenumber from lineitem)"


@query("dq_null_keys", _rule_sql("null_keys", "count(*)", "count_if(k is null)") + f" from {_BLANKED}")
def dq_null_keys(spark, sf_dir):
    keyed = _lines(spark, sf_dir).selectExpr("nullif(l_orderkey % 10, l_linenumber) as k")
    return _only(Q.check_counts(keyed, Q.KeyRule(("k",))), "null_keys")


# NULL counts as a key value here, unlike count(distinct k).
@query(
    "dq_duplicate_keys",
    _rule_sql("duplicate_keys", "sum(n)", "sum(n) - count(*)")
    + """ from (select nullif(l_orderkey, 7) k1, l_linenumber k2, count(*) n
          from lineitem group by all)""",
)
def dq_duplicate_keys(spark, sf_dir):
    keyed = _lines(spark, sf_dir).selectExpr("nullif(l_orderkey, 7) as k1", "l_linenumber as k2")
    return _only(Q.check_keys(keyed, Q.KeyRule(("k1", "k2"))), "duplicate_keys")


@query(
    "dq_expected_count",
    _rule_sql("expected_count", "count(*)", "abs(count(*) - 2000)") + " from part",
)
def dq_expected_count(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return _only(Q.check_counts(part, Q.KeyRule(("p_partkey",), 2000)), "expected_count")


_DEPTS = ", ".join("'" + d["department"] + "'" for d in values.departments())


# The unit check sees the part types as well, which are not allowed units.
@query(
    "dq_allowed_values",
    f"with {SILVER} "
    + _row_sql("allowed department", f"department not in ({_DEPTS})")
    + " union all "
    + _row_sql("allowed unit_of_measure", "unit_of_measure not in ('each','kg','g','L','mL','pack')")
    + " union all "
    + _row_sql("allowed p_type", "p_type not in ('ECONOMY', 'PROMO')", source="part"),
)
def dq_allowed_values(spark, sf_dir):
    rules = _named("allowed department", "allowed unit_of_measure")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    own = Q.check_rows(part, [Q.allowed_values("p_type", ("ECONOMY", "PROMO"))])
    return Q.check_rows(_silver(spark, sf_dir), rules).unionByName(own)


# Checked on the price before its repair, so that failures occur.
@query(
    "dq_retail_above_cost",
    f"with {PARTS} "
    + _row_sql("retail above cost", "not retail > cost", source="parts")
    + " union all "
    + _row_sql("charm above cost", "not charm > cost", source="parts"),
)
def dq_retail_above_cost(spark, sf_dir):
    rules = [
        Q.RowRule("retail above cost", "retail > cost"),
        Q.RowRule("charm above cost", "charm > cost"),
    ]
    return Q.check_rows(read_part_products(spark, sf_dir), rules)


@query(
    "dq_charm_endings",
    f"with {SPOILED_SQL} "
    + _row_sql(
        "price endings",
        "retail_price_aud - floor(retail_price_aud) not in (0.49, 0.79, 0.95, 0.99)",
        source="spoiled",
    ),
)
def dq_charm_endings(spark, sf_dir):
    return Q.check_rows(_spoiled(spark, sf_dir), _named("price endings"))


@query(
    "dq_supplier_pattern",
    f"with {SPOILED_SQL} "
    + _row_sql("supplier pattern", "not (supplier_id like 'SUP%' and length(supplier_id) = 7)", source="spoiled")
    + " union all "
    + _row_sql("supplier name", r"not regexp_matches(s_name, '^Supplier#[0-9]{9}$')", source="supplier"),
)
def dq_supplier_pattern(spark, sf_dir):
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    named = Q.check_rows(
        supplier, [Q.RowRule("supplier name", "s_name rlike '^Supplier#[0-9]{9}$'")]
    )
    return Q.check_rows(_spoiled(spark, sf_dir), _named("supplier pattern")).unionByName(named)


_FRESH = "department = 'Fresh Produce'"


@query(
    "dq_conditional",
    f"with {SPOILED_SQL} "
    + " union all ".join(
        [
            _row_sql("fresh has shelf life", "not coalesce(shelf_life_days > 0, false)", _FRESH, "spoiled"),
            _row_sql(
                "fresh has wastage",
                "not coalesce(wastage_rate_baseline between 0 and 1, false)",
                _FRESH,
                "spoiled",
            ),
            _row_sql("fresh has months", "false", _FRESH, "spoiled"),
            _row_sql("fresh is gst free", "gst_applicable", _FRESH, "spoiled"),
            _row_sql("alcohol has gst", "not gst_applicable", "department = 'Alcohol'", "spoiled"),
        ]
    ),
)
def dq_conditional(spark, sf_dir):
    names = (
        "fresh has shelf life", "fresh has wastage", "fresh has months", "fresh is gst free",
        "alcohol has gst",
    )
    return Q.check_rows(_spoiled(spark, sf_dir), _named(*names))


_OFF = "abs(coalesce(n, 0) - target) > greatest(2, floor(target * 0.05)::bigint)"


@query(
    "dq_group_share",
    f"""with {PARTS}, counted as (select department d, count(*) n from parts group by department),
        goal as (select department, weight target from department)
        select 'share of ' || department as rule, coalesce(n, 0)::bigint n_rows,
          case when {_OFF} then abs(coalesce(n, 0) - target) else 0 end::bigint n_failed,
          not ({_OFF}) passed
        from goal left join counted on d = department""",
)
def dq_group_share(spark, sf_dir):
    goal = Lookups.builtin(spark).table("department")
    return Q.check_group_share(_silver(spark, sf_dir), "department", goal, "weight")


@query(
    "dq_group_rate",
    f"""with {PARTS}, r as (select count_if(department = 'Pantry') n,
          count_if(department = 'Pantry' and is_private_label) hits from parts)
        select 'pantry private label' as rule, n::bigint n_rows,
          case when hits / n between 0.25 and 0.45 then 0 else n end::bigint n_failed,
          hits / n between 0.25 and 0.45 passed from r""",
)
def dq_group_rate(spark, sf_dir):
    return Q.check_group_rate(
        _silver(spark, sf_dir),
        "department = 'Pantry'", "is_private_label", 0.25, 0.45, "pantry private label",
    )


@query(
    "dq_range",
    f"with {SILVER} "
    + _row_sql(
        "shelf life range",
        "not (shelf_life_days between 1 and 90)",
        "shelf_life_days is not null",
    )
    + " union all "
    + _row_sql(
        "wastage range",
        "not (wastage_rate_baseline > 0 and wastage_rate_baseline <= 0.10)",
        "wastage_rate_baseline is not null",
    ),
)
def dq_range(spark, sf_dir):
    rules = [
        Q.RowRule("shelf life range", "shelf_life_days between 1 and 90", "shelf_life_days is not null"),
        Q.RowRule(
            "wastage range",
            "wastage_rate_baseline > 0 and wastage_rate_baseline <= 0.10",
            "wastage_rate_baseline is not null",
        ),
    ]
    return Q.check_rows(_silver(spark, sf_dir), rules)


_ORPHANS = """select '{name}' as rule, count(*)::bigint n_rows,
  count_if(p.k is null)::bigint n_failed, count_if(p.k is null) = 0 passed
  from {child} c left join (select distinct {parent_key} k from {parent}) p on c.{key} = p.k"""


@query(
    "dq_referential",
    f"with {PARTS} "
    + " union all ".join(
        [
            _ORPHANS.format(name="line has part", child="lineitem", key="l_partkey",
                            parent="part", parent_key="p_partkey"),
            _ORPHANS.format(name="order has lines", child="orders", key="o_orderkey",
                            parent="lineitem", parent_key="l_orderkey"),
            _ORPHANS.format(name="product department", child="parts", key="department",
                            parent="taxonomy", parent_key="department"),
        ]
    ),
)
def dq_referential(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    taxonomy = Lookups.builtin(spark).table("taxonomy")
    checks = [
        Q.check_reference(lines, "l_partkey", part, "p_partkey", "line has part"),
        Q.check_reference(orders, "o_orderkey", lines, "l_orderkey", "order has lines"),
        Q.check_reference(
            _silver(spark, sf_dir), "department", taxonomy, "department", "product department"
        ),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query(
    "dq_suite_silver",
    f"with {SILVER}, keyed as (select product_id, count(*) n from silver group by product_id) "
    + " union all ".join(
        [
            _rule_sql("row_count", "count(*)", "0") + " from silver",
            _rule_sql("null_keys", "count(*)", "count_if(product_id is null)") + " from silver",
            _rule_sql("duplicate_keys", "sum(n)", "sum(n) - count(*)") + " from keyed",
            _rule_sql("expected_count", "count(*)", "abs(count(*) - 2000)") + " from silver",
            _row_sql("allowed department", f"department not in ({_DEPTS})"),
            _row_sql(
                "allowed unit_of_measure",
                "unit_of_measure not in ('each','kg','g','L','mL','pack')",
            ),
            _row_sql("retail above cost", "retail_price_aud <= cost_price_aud"),
            _row_sql(
                "price endings",
                "retail_price_aud - floor(retail_price_aud) not in (0.49, 0.79, 0.95, 0.99)",
            ),
            _row_sql("supplier pattern", "not (supplier_id like 'SUP%' and length(supplier_id) = 7)"),
            _row_sql("fresh has shelf life", "not coalesce(shelf_life_days > 0, false)", _FRESH),
            _row_sql(
                "fresh has wastage",
                "not coalesce(wastage_rate_baseline between 0 and 1, false)",
                _FRESH,
            ),
            _row_sql("fresh has months", "false", _FRESH),
            _row_sql("fresh is gst free", "gst_applicable", _FRESH),
            _row_sql("alcohol has gst", "not gst_applicable", "department = 'Alcohol'"),
            _row_sql("season vector", "false"),
        ]
    ),
)
def dq_suite_silver(spark, sf_dir):
    return Q.check_suite(_silver(spark, sf_dir), Q.silver_suite(2000, full=True))
