"""Stored totals that follow increments.

A batch's totals go to a folder of their own, which a repeated batch replaces; adding reads nothing that is stored. Reading
sums the folders up; ``fold`` sums those up to a batch into one base, so their number stays small. A folder counts
once it is complete, so a run that dies leaves what was there. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.session import exists, folders, remove


class Totals:
    """Totals by ``groups`` (the first one is the folder key): summed columns, and distinct counts as sketches."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, groups: Sequence[str], sketches: Sequence[str] = ()):
        self.spark, self.path, self.schema = spark, path, schema
        self.groups, self.sketches = list(groups), list(sketches)

    def _complete(self, kind: str) -> dict[int, str]:
        names = [n for n in folders(self.spark, self.path) if n.startswith(f"part={kind}-")]
        return {int(n.rsplit("-", 1)[1]): n for n in names if exists(self.spark, f"{self.path}/{n}/_SUCCESS")}

    def folded(self) -> int:
        """The batch up to which the base counts; -1 without a base."""
        return max(self._complete("base"), default=-1)

    def _live(self, upto: int | None = None) -> list[str]:
        base, mark = self._complete("base"), self.folded()
        own = [n for b, n in sorted(self._complete("batch").items()) if b > mark and (upto is None or b <= upto)]
        return ([base[mark]] if base else []) + own

    def _write(self, df: DataFrame, name: str) -> None:
        key = self.groups[0]
        shaped = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        shaped.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(f"{self.path}/part={name}")

    def add(self, totals: DataFrame, batch: int) -> bool:
        """Store the totals of ``batch`` (0 or more). A batch below the base has been counted: nothing is done, False."""
        if batch < 0:
            raise ValueError(f"batches are numbered from 0, not {batch}")
        if batch <= self.folded():
            return False
        self._write(totals, f"batch-{batch:012d}")
        return True

    def _summed(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in names])
        kept = [f for f in self.schema if f.name not in self.groups]
        sums = [F.hll_union_agg(f.name) if f.name in self.sketches else F.sum(f.name).cast(f.dataType) for f in kept]
        return rows.groupBy(*self.groups).agg(*[s.alias(f.name) for s, f in zip(sums, kept)])

    def read(self) -> DataFrame:
        """All totals; a filter on the folder key opens its folders alone."""
        return self._summed(self._live())

    def fold(self, upto: int) -> None:
        """Sum the batches up to ``upto`` and the base into a new base. The old folders go once it is complete."""
        names = self._live(upto)
        if upto <= self.folded() or not names:
            return
        self._write(self._summed(names), f"base-{upto:012d}")
        for name in names:
            remove(self.spark, f"{self.path}/{name}")
