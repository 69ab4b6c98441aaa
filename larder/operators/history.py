"""Keeping the latest row, surrogate keys and slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN_KEY = -1


def dedup_latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key: the one with the highest ``version`` columns, then the highest remaining
    columns, so the choice never depends on row order.

    Spark keeps one row per key and task before the shuffle (a group limit under the ranking), so a key
    that holds much of the table does not end up in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*version, *[c for c in rest if c not in version]]
    best = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = df.withColumn("_place", F.row_number().over(best)).filter("_place = 1")
    return ranked.select(*df.columns)


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop rows that repeat in every column."""
    return df.dropDuplicates()


def with_surrogate_key(dim: DataFrame, natural: Sequence[str], out: str) -> DataFrame:
    """64-bit hash of the natural key: the same in every run, without numbering the rows.

    A repeated natural key would multiply facts and a collision (likely beyond some 10^9 keys) would mix
    them, so either raises here, before anything is loaded.
    """
    keyed = dim.select(F.xxhash64(*natural).alias(out), *dim.columns)
    if repeated := keyed.groupBy(out).count().filter("count > 1").limit(5).collect():
        raise ValueError(f"{list(natural)} gives {out} values more than once: {[r[0] for r in repeated]}")
    return keyed


def swap_keys(facts: DataFrame, dim: DataFrame, on: dict[str, str], surrogate: str) -> DataFrame:
    """Replace the natural key of the facts (``on``: fact column to dimension column) by the
    surrogate; facts without a dimension row get the unknown key."""
    known = dim.select(
        *[F.col(d).alias(f"_dim_{d}") for d in on.values()], F.col(surrogate).alias("_sk")
    )
    cond = [F.col(f) == F.col(f"_dim_{d}") for f, d in on.items()]
    keep = [c for c in facts.columns if c not in on]
    return facts.join(known, cond, "left").select(
        F.coalesce("_sk", F.lit(UNKNOWN_KEY)).alias(surrogate), *keep
    )


def open_history(df: DataFrame, since: date) -> DataFrame:
    """First version of a dimension: every row valid from ``since`` on."""
    return df.select(
        *df.columns,
        F.lit(since).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(
    dim: DataFrame, snapshot: DataFrame, key: str | Sequence[str], as_of: date
) -> DataFrame:
    """Type 2 history after a full snapshot of the source.

    Changed and vanished rows are closed at ``as_of``, changed and new rows opened. Keys (one column
    or several) are unique on both sides; a missing key is a key value of its own. One full outer join
    carries everything, each side with a flag, and closed rows pass by it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    attrs = [c for c in snapshot.columns if c not in keys]
    columns = [*keys, *attrs, "valid_from", "valid_to", "is_current"]
    current = dim.filter("is_current").select(*columns, F.lit(True).alias("_old")).alias("o")
    fresh = snapshot.select(*keys, *attrs, F.lit(True).alias("_new")).alias("n")
    same = " and ".join(f"o.`{a}` <=> n.`{a}`" for a in attrs) or "true"
    on = " and ".join(f"o.`{k}` <=> n.`{k}`" for k in keys)
    state = current.join(fresh, F.expr(on), "full_outer").selectExpr(
        "o.*",
        *[f"n.`{c}` as `_n_{c}`" for c in [*keys, *attrs]],
        f"case when _old and _new and {same} then 'same' when _old and _new then 'changed'"
        " when _old then 'gone' else 'new' end as _state",
    )
    sides = state.select("*", F.explode(F.array(F.lit("old"), F.lit("new"))).alias("_side"))
    sides = sides.filter(
        "(_side = 'old' and _state <> 'new') or (_side = 'new' and _state in ('new', 'changed'))"
    )
    opened = "_side = 'new'"
    day = f"date '{as_of.isoformat()}'"
    merged = sides.selectExpr(
        *[f"if({opened}, `_n_{c}`, `{c}`) as `{c}`" for c in [*keys, *attrs]],
        f"if({opened}, {day}, valid_from) as valid_from",
        f"case when {opened} or _state = 'same' then valid_to else {day} end as valid_to",
        f"{opened} or _state = 'same' as is_current",
    )
    return merged.unionByName(dim.filter("not is_current").select(*columns))
