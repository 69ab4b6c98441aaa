"""Quality rules as data, their evaluation, and the gate in front of a write.

Every report has one row per rule: ``rule, n_rows, n_failed, passed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import values
from larder.functions import rules as R


@dataclass(frozen=True)
class RowRule:
    """``ok`` must hold for each row where ``when`` holds. An unknown ``ok`` fails."""

    name: str
    ok: str
    when: str = "true"


@dataclass(frozen=True)
class KeyRule:
    """No missing keys, no repeated keys and, if given, the expected number of rows."""

    keys: tuple[str, ...]
    expected_rows: int | None = None


@dataclass(frozen=True)
class Suite:
    """The rules of one layer."""

    name: str
    key: KeyRule | None = None
    rows: tuple[RowRule, ...] = field(default=())


class GateFailed(ValueError):
    """A quality gate stopped the run."""


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _report_rows(entries: Sequence[tuple[str, str, str]]) -> str:
    """SQL that turns (rule, n_rows, n_failed) expressions into report rows."""
    structs = ", ".join(
        f"named_struct('rule', {_quoted(rule)}, 'n_rows', cast({n} as bigint),"
        f" 'n_failed', cast({bad} as bigint), 'passed', {bad} = 0)"
        for rule, n, bad in entries
    )
    return f"inline(array({structs}))"


def check_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules in one aggregate: one scan of the columns they need, no row is shuffled."""
    aggs = []
    for i, r in enumerate(rules):
        aggs.append(F.expr(f"count_if({r.when})").alias(f"n{i}"))
        aggs.append(F.expr(f"count_if(({r.when}) and not coalesce({r.ok}, false))").alias(f"f{i}"))
    entries = [(r.name, f"n{i}", f"f{i}") for i, r in enumerate(rules)]
    return df.agg(*aggs).selectExpr(_report_rows(entries))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows without a key. NULL counts as a key value of its own.

    Two-level aggregate over the key columns alone: a key that repeats a lot collapses before the
    shuffle, and row, NULL and duplicate checks share one scan.
    """
    missing = " or ".join(f"{k} is null" for k in keys)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .selectExpr("n", f"{missing} as missing")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count("*").alias("n_keys"),
            F.coalesce(F.expr("sum(if(missing, n, 0))"), F.lit(0)).alias("n_missing"),
        )
    )


def check_counts(df: DataFrame, rule: KeyRule) -> DataFrame:
    """Row count, missing keys and expected count alone: one aggregate, no key is shuffled."""
    missing = " or ".join(f"{k} is null" for k in rule.keys)
    counted = df.agg(F.count("*").alias("n_rows"), F.expr(f"count_if({missing})").alias("n_missing"))
    entries = [("row_count", "n_rows", "0"), ("null_keys", "n_rows", "n_missing")]
    if rule.expected_rows is not None:
        entries.append(("expected_count", "n_rows", f"abs(n_rows - {rule.expected_rows})"))
    return counted.selectExpr(_report_rows(entries))


def check_keys(df: DataFrame, rule: KeyRule) -> DataFrame:
    entries = [
        ("row_count", "n_rows", "0"),
        ("null_keys", "n_rows", "n_missing"),
        ("duplicate_keys", "n_rows", "(n_rows - n_keys)"),
    ]
    if rule.expected_rows is not None:
        entries.append(("expected_count", "n_rows", f"abs(n_rows - {rule.expected_rows})"))
    return key_counts(df, rule.keys).selectExpr(_report_rows(entries))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The offending keys with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def check_group_share(
    df: DataFrame, group: str, targets: DataFrame, target: str, slack: int = 2, share: float = 0.05
) -> DataFrame:
    """Rows per group against a target: off by at most max(slack, share of the target).

    A group without a target fails with all its rows.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    goal = targets.selectExpr(f"{group} as _goal", f"cast({target} as bigint) as target")
    limit = f"greatest({slack}, cast(floor(target * {share}D) as bigint))"
    off = f"(target is null or abs(coalesce(n, 0) - target) > {limit})"
    both = goal.join(counts, F.col(group).eqNullSafe(F.col("_goal")), "full_outer")
    return both.selectExpr(
        f"concat('share of ', coalesce(_goal, cast({group} as string), 'NULL')) as rule",
        "coalesce(n, 0) as n_rows",
        f"if({off}, abs(coalesce(n, 0) - coalesce(target, 0)), 0) as n_failed",
        f"not ({off}) as passed",
    )


def check_group_rate(
    df: DataFrame, where: str, flag: str, low: float, high: float, name: str
) -> DataFrame:
    """Rate of a flag among the rows of a group must lie in [low, high]."""
    out = df.agg(
        F.expr(f"count_if({where})").alias("n"),
        F.expr(f"count_if(({where}) and {flag})").alias("hits"),
    )
    ok = f"(n > 0 and hits / n between {low}D and {high}D)"
    return out.selectExpr(
        f"{_quoted(name)} as rule", "n as n_rows", f"if({ok}, 0L, n) as n_failed", f"{ok} as passed"
    )


def check_reference(df: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str):
    """Rows whose key has no parent. The child is grouped first, so a hot key is joined once."""
    keys = df.groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("_known")).distinct()
    found = keys.join(known.withColumn("_hit", F.lit(True)), F.col(key) == F.col("_known"), "left")
    out = found.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.expr("sum(if(_hit is null, n, 0))"), F.lit(0)).alias("bad"),
    )
    return out.selectExpr(_report_rows([(name, "n", "bad")]))


def check_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """The whole suite. Key and row rules read different columns of ``df``, each once."""
    parts = []
    if suite.key is not None:
        parts.append(check_keys(df, suite.key))
    if suite.rows:
        parts.append(check_rows(df, suite.rows))
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame, what: str) -> list:
    """Raise :class:`GateFailed` if a rule failed; returns the report rows (one per rule)."""
    rows = report.collect()
    bad = [f"{r.rule}: {r.n_failed} of {r.n_rows}" for r in rows if not r.passed]
    if bad:
        raise GateFailed(f"{what}: " + "; ".join(bad))
    return rows


# ---- the rules of the product layers -----------------------------------------------------------


def allowed_values(column: str, options: Sequence[str]) -> RowRule:
    listed = ", ".join("'" + o.replace("'", "''") + "'" for o in options)
    return RowRule(f"allowed {column}", f"{column} in ({listed})")


def product_rules() -> tuple[RowRule, ...]:
    departments = [d["department"] for d in values.departments()]
    cents = "cast(retail_price_aud - floor(retail_price_aud) as decimal(10,2))"
    endings = ", ".join(values.PRICE_ENDINGS)
    fresh = "department = 'Fresh Produce'"
    return (
        allowed_values("department", departments),
        allowed_values("unit_of_measure", values.UNITS),
        RowRule("retail above cost", "retail_price_aud > cost_price_aud"),
        RowRule("price endings", f"{cents} in ({endings})"),
        RowRule("supplier pattern", "startswith(supplier_id, 'SUP') and length(supplier_id) = 7"),
        RowRule("fresh has shelf life", "shelf_life_days > 0", fresh),
        RowRule("fresh has wastage", "wastage_rate_baseline between 0 and 1", fresh),
        RowRule("fresh has months", "peak_season_months is not null", fresh),
        RowRule("fresh is gst free", "not gst_applicable", fresh),
        RowRule("alcohol has gst", "gst_applicable", "department = 'Alcohol'"),
        RowRule("season vector", R.vector_ok("seasonality_vector")),
    )


def cast_rules() -> tuple[RowRule, ...]:
    """For the rows before they are typed: no value may be lost by a cast."""
    typed = {"cost_price_aud": "decimal(10,2)", "retail_price_aud": "decimal(10,2)", "pack_size": "decimal(10,3)"}
    return tuple(
        RowRule(f"cast keeps {c}", f"try_cast({c} as {t}) is not null", f"{c} is not null")
        for c, t in typed.items()
    )


def gold_rules() -> tuple[RowRule, ...]:
    return (
        allowed_values("price_tier", ("Budget", "Mid", "Premium")),
        RowRule("margin known", "margin_pct is not null"),
        RowRule("perishable flag", "is_perishable = (shelf_life_days is not null)"),
    )


def bronze_suite(raw: DataFrame) -> Suite:
    """The bronze gate: raw rows are there and carry a key."""
    rules = (RowRule("product_id given", "product_id is not null"),) if "product_id" in raw.columns else ()
    return Suite("bronze", None, rules)


def silver_suite(expected_rows: int | None = 2000, full: bool = True) -> Suite:
    """The silver gate; ``full`` adds the product rules to the key checks."""
    rules = product_rules() if full else ()
    return Suite("silver", KeyRule(("product_id",), expected_rows), rules)


def gold_suite() -> Suite:
    return Suite("gold", None, gold_rules())
