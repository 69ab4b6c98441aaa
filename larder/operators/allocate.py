"""Largest-remainder allocation and its expansion to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bins of remainders, and slots of ties inside one remainder.
BINS, SLOTS = 1024, 1024
#: Numbers that are placed together when an allocation is expanded.
STRIDE = 65_536


def allocate(
    weights: DataFrame, n: int | Column, weight: str = "weight", tie: str = "alloc_no",
    out: str = "n",
) -> DataFrame:
    """Split ``n`` rows over the weights: whole shares first, then one spare row each to the largest
    remainders, equal remainders by ``tie``.

    Integer arithmetic throughout. A rank is the number of rows with larger remainders plus the place
    among equal ones. The first comes from one row per distinct remainder, summed up in bins over the
    range that remainders take; the second from slots of the tie (equal parts of a number's range, the first characters of a
    text after what all texts begin with), so equal remainders are dealt out over many tasks. A single task sees ``BINS`` rows. ``n``
    may be a scalar subquery such as ``df.agg(F.count("*")).scalar()``.

    A missing weight is 0, a missing tie comes first, and every row comes back once. Weights that sum up to 0
    have no shares: the division by zero raises.
    """
    n = (n if isinstance(n, Column) else F.lit(n)).cast("decimal(19,0)")
    given = F.coalesce(F.col(weight), F.lit(0))
    total = weights.agg(F.coalesce(F.sum(given), F.lit(0)).cast("bigint").alias("_t")).scalar()
    # A share w*n/total: quotient and remainder of exact integers.
    exact = F.col("_w") * F.col("_n")
    shares = (
        weights.withColumns({"_w": given.cast("decimal(18,0)"), "_n": n, "_total": total})
        .withColumn("_rem", (exact % F.col("_total")).cast("decimal(19,0)"))
        .withColumn("_floor", ((exact - F.col("_rem")) / F.col("_total")).cast("bigint"))
    )
    shares = shares.withColumn("_slot", _slot(weights, tie))
    cells = shares.groupBy("_rem", "_slot").agg(
        F.count("*").alias("_c"), F.sum("_floor").alias("_f")
    )
    rems = cells.groupBy("_rem").agg(F.sum("_c").alias("_c"), F.sum("_f").alias("_f"))
    top = shares.agg(F.max("_rem").alias("_m")).scalar()
    share = F.col("_rem").cast("double") / F.greatest(top, F.lit(1)).cast("double")
    rems = rems.withColumn("_bin", F.floor(share * F.lit(float(BINS))))
    bins = rems.groupBy("_bin").agg(F.sum("_c").alias("_c"), F.sum("_f").alias("_f"))
    above = W.orderBy(F.desc("_bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = bins.select(
        "_bin",
        F.coalesce(F.sum("_c").over(above), F.lit(0)).alias("_above"),
        F.sum("_f").over(W.partitionBy()).alias("_all_floor"),
    )
    larger = W.partitionBy("_bin").orderBy(F.desc("_rem")).rowsBetween(W.unboundedPreceding, -1)
    rems = rems.join(F.broadcast(bins), "_bin").select(  # at most BINS + 1 rows
        "_rem", "_all_floor",
        (F.col("_above") + F.coalesce(F.sum("_c").over(larger), F.lit(0))).alias("_above"),
    )
    earlier = W.partitionBy("_rem").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(
        "_rem", "_slot", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_earlier")
    ).join(rems, "_rem")
    place = F.row_number().over(W.partitionBy("_rem", "_slot").orderBy(tie))
    spare = F.col("_n") - F.col("_all_floor")
    rank = F.col("_above") + F.col("_earlier") + F.col("_place")
    return (
        shares.withColumn("_place", place)
        .join(cells, ["_rem", "_slot"])
        .withColumn(out, F.col("_floor") + F.when(rank <= spare, 1).otherwise(0))
        .select(*[F.col(f"`{c}`") for c in weights.columns if c != out], out)
    )


def _slot(weights: DataFrame, tie: str) -> Column:
    """A number or text that grows with the tie, and is never NULL: for numbers their place in the range, for text
    some characters after the common beginning of all texts."""
    kind = dict(weights.dtypes)[tie]
    x = F.col(f"`{tie}`")
    if kind == "string":
        # What the least and the largest text begin with, all begin with.
        ends = weights.agg(F.min(x).alias("a"), F.max(x).alias("b"))
        upto = F.sequence(F.lit(0), F.coalesce(F.least(F.length("a"), F.length("b")), F.lit(0)))
        common = ends.select(F.array_max(F.filter(upto, lambda i: F.left("a", i) == F.left("b", i)))).scalar()
        return F.coalesce(x.substr(F.coalesce(common, F.lit(0)) + 1, F.lit(12)), F.lit(""))
    bounds = weights.agg(
        F.struct(F.min(x).cast("double").alias("a"), F.max(x).cast("double").alias("b")).alias("s")
    ).scalar()
    wide = (bounds["b"] - bounds["a"]) / SLOTS
    slot = F.when(wide > 0, F.floor((x.cast("double") - bounds["a"]) / wide)).otherwise(F.lit(0))
    return F.coalesce(slot, F.lit(-1))


def bounds(
    allocation: DataFrame, order: str = "dept_no", n: str = "n", chunk: int = 4096
) -> DataFrame:
    """Adds ``lo`` and ``hi``: rows lo+1..hi belong to the group. ``order`` numbers the groups.

    Running totals in two levels, inside chunks of groups and over the chunk totals, so a long
    allocation does not pass through one task: a single one sees groups / ``chunk`` rows.
    """
    rows = allocation.withColumn("_chunk", F.floor(F.col(order) / chunk))
    before = W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("_chunk").agg(F.sum(n).alias("_sum"))
    base = base.select("_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    upto = W.partitionBy("_chunk").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("hi", F.sum(n).over(upto)).join(base, "_chunk")
    rows = rows.withColumn("hi", F.col("hi") + F.col("_base"))
    return rows.withColumn("lo", F.col("hi") - F.col(n)).drop("_chunk", "_base")


def expand(
    rows: DataFrame, number: str, allocation: DataFrame, order: str = "dept_no", n: str = "n",
    stride: int = STRIDE,
) -> DataFrame:
    """The group that each row's ``number`` (from 1 on) falls into as ``order``, and the running number
    there as ``in_group``. Numbers outside 1..total belong to no group and are dropped.

    Numbers are dealt out in blocks of ``stride``. A group puts a mark where it begins in each block it
    touches, and a row takes the last mark at or before it: linear in rows and groups, for any number
    and size of groups.
    """
    listed = bounds(allocation, order, n).filter(F.col(n) > 0)
    block = F.explode(
        F.sequence(F.floor(F.col("lo") / stride), F.floor((F.col("hi") - 1) / stride))
    ).alias("_block")
    group = F.struct(F.col(order).alias("group"), "lo", "hi").alias("_group")
    marks = listed.select(block, group)
    marks = marks.withColumn("_at", F.greatest(F.col("_group.lo"), F.col("_block") * stride) + 1)
    x = F.col(number).cast("bigint")
    given = rows.select(
        F.floor((x - 1) / stride).alias("_block"), x.alias("_at"), F.struct(*rows.columns).alias("_row")
    )
    both = given.unionByName(marks, allowMissingColumns=True)
    # At one number the mark comes first.
    upto = W.partitionBy("_block").orderBy("_at", F.col("_row").isNotNull())
    placed = both.withColumn("_group", F.last("_group", ignorenulls=True).over(upto))
    placed = placed.filter("_row is not null and _at > _group.lo and _at <= _group.hi")
    return placed.select(
        "_row.*",
        F.col("_group.group").alias(order),
        (F.col("_at") - F.col("_group.lo")).alias("in_group"),
    )
