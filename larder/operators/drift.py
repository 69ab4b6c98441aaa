"""Profiles of batches, how far a batch has drifted from the last good one, and the gate on it.

A profile counts a column's values in bins: 0 for NULL; of a number those up to each decile, then the rest; of a text each of the
commonest values, then the rest. A batch is counted in the bins of the last good profile, so both have the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.operators.quality import GateFailed
from larder.session import exists, folders

SCHEMA = "name string, bin int, edge string, n bigint"
DECILES = [i / 10 for i in range(1, 10)]


@dataclass(frozen=True)
class Limits:
    """What a column may drift: population stability index, Kolmogorov-Smirnov distance, change of the share of NULL."""

    psi: float = 0.2
    ks: float = 0.15
    nulls: float = 0.05


def edges_of(df: DataFrame, numbers: Sequence[str], texts: Sequence[str], top: int = 8) -> dict[str, list]:
    """Upper ends of a number's bins, commonest values of a text (ties: least value first). At most 9 or ``top`` of them."""
    out: dict[str, list] = {}
    if numbers:
        shares = F.array(*map(F.lit, DECILES))
        found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in numbers]).first()
        out |= {c: sorted(set(found[c] or [])) for c in numbers}
    for c in texts:
        common = df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(top)
        out[c] = [r[0] for r in common.collect()]
    return out


def _bin(c: str, edges: list) -> Column:
    """The number of a value's bin: a chain over the edges, the first that holds."""
    x = F.col(c)
    number = bool(edges) and isinstance(edges[0], float)
    chain = F.when(x.isNull(), 0)
    for i, e in enumerate(edges, 1):
        chain = chain.when(x.cast("double") <= F.lit(e) if number else x == F.lit(e), i)
    return chain.otherwise(len(edges) + 1)


def profile(df: DataFrame, edges: dict[str, list]) -> DataFrame:
    """(name, bin, edge, n) with a row for every bin, empty ones too. One pass; tasks send one row per column and bin."""
    spark = df.sparkSession
    bins = [(c, i, str(e[i - 1]) if 0 < i <= len(e) else None) for c, e in edges.items() for i in range(len(e) + 2)]
    every = spark.createDataFrame(bins, "name string, bin int, edge string")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), _bin(c, e).alias("bin")) for c, e in edges.items()]))
    counted = df.select(cells.alias("c")).groupBy("c.name", "c.bin").agg(F.count("*").alias("n"))
    return every.join(counted, ["name", "bin"], "left").select("name", "bin", "edge", F.coalesce("n", F.lit(0)).alias("n"))


def drift(good: DataFrame, new: DataFrame, numbers: Sequence[str], limits: Limits = Limits()) -> DataFrame:
    """One row per column of two profiles in the same bins: name, psi, ks (numbers), null_change, passed.

    The index runs over shares with half a row added to each bin, so empty bins count. An empty batch has shares of 0.
    """
    both = good.select("name", "bin", F.col("n").alias("a")).join(new.select("name", "bin", F.col("n").alias("b")), ["name", "bin"])
    column, upto = W.partitionBy("name"), W.partitionBy("name").orderBy("bin")
    filled = F.when(F.col("bin") > 0, F.lit(1)).otherwise(0)

    def shares(c: str) -> dict[str, Column]:
        n, some = F.sum(c).over(column), F.sum(F.col(c) * filled).over(column)
        return {
            f"p_{c}": (F.col(c) + 0.5) / (n + 0.5 * F.count("*").over(column)),
            f"null_{c}": F.when(F.col("bin") == 0, F.coalesce(F.try_divide(F.col(c), n), F.lit(0.0))),
            f"cum_{c}": F.coalesce(F.try_divide(F.sum(F.col(c) * filled).over(upto), some), F.lit(0.0)),
        }

    told = both.select("name", "bin", *[x.alias(k) for c in "ab" for k, x in shares(c).items()])
    rows = told.groupBy("name").agg(
        F.sum((F.col("p_b") - F.col("p_a")) * F.ln(F.col("p_b") / F.col("p_a"))).alias("psi"),
        F.max(F.abs(F.col("cum_b") - F.col("cum_a"))).alias("ks"),
        F.max(F.abs(F.col("null_b") - F.col("null_a"))).alias("null_change"),
    )
    ks = F.when(F.col("name").isin(list(numbers)), F.col("ks"))
    ok = (F.col("psi") <= limits.psi) & (F.coalesce(ks, F.lit(0.0)) <= limits.ks) & (F.col("null_change") <= limits.nulls)
    return rows.select("name", "psi", ks.alias("ks"), "null_change", ok.alias("passed"))


class DriftGate:
    """Profiles of good batches below ``path``, a folder each; ``check`` stops a batch that has drifted too far."""

    def __init__(self, spark: SparkSession, path: str, numbers: Sequence[str], texts: Sequence[str] = (), limits: Limits = Limits(), top: int = 8):
        self.spark, self.path, self.numbers, self.texts, self.limits, self.top = spark, path, list(numbers), list(texts), limits, top

    def _last_good(self, batch: int) -> DataFrame | None:
        done = [int(n[6:]) for n in folders(self.spark, self.path) if n.startswith("batch=") and exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        before = [b for b in done if b < batch]
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/batch={max(before)}") if before else None

    def report(self, df: DataFrame, batch: int) -> DataFrame | None:
        """How far ``df`` is from the last good batch before ``batch``; None where there is none."""
        good = self._last_good(batch)
        if good is None:
            return None
        edges: dict[str, list] = {c: [] for c in [*self.numbers, *self.texts]}
        for r in good.where("edge is not null").orderBy("name", "bin").collect():
            if r.name in edges:
                edges[r.name].append(float(r.edge) if r.name in self.numbers else r.edge)
        return drift(good, profile(df, edges), self.numbers, self.limits)

    def check(self, df: DataFrame, batch: int) -> None:
        """Raise :class:`GateFailed` with the columns that drifted, or store the profile as a good one. The first batch is good."""
        told = self.report(df, batch)
        bad = sorted(r.name for r in told.where("not passed").collect()) if told is not None else []
        if bad:
            raise GateFailed(f"batch {batch} drifted in {', '.join(bad)}")
        own = profile(df, edges_of(df, self.numbers, self.texts, self.top))
        own.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
