"""Tables laid out along a space-filling curve, with a manifest of each file's ranges to prune by.

Each key's values become places between its quantiles, so skewed keys spread too; the places' bits, interleaved, are the place
on a Z-shaped curve. Rows are range-partitioned by it, so a file covers a small box of all keys at once, and a range over any of
them needs few files. The manifest has a row per file: rows, least and greatest value of each key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.session import exists

BITS = 6


def _count_below(value: Column):
    return lambda n, edge: n + F.when(edge < value, 1).otherwise(0)


def curve_place(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the curve; NULL has place 0 in its key. One pass finds the quantiles of all keys."""
    parts = 1 << bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = df.agg(*[F.transform(F.percentile_approx(k, shares, 10_000), lambda c: c.cast("string")).alias(k) for k in keys]).first()
    places = []
    for k in keys:
        edges = F.array(*[F.lit(c) for c in sorted(set(cuts[k] or []), key=cuts[k].index)]) if cuts[k] else F.array(F.lit(None).cast("string"))
        typed = edges.cast(f"array<{df.schema[k].dataType.simpleString()}>")
        value = F.col(k)
        below = F.aggregate(typed, F.lit(0), _count_below(value))
        places.append(F.when(value.isNull(), 0).otherwise(below).cast("bigint"))
    bit = [F.shiftleft(F.shiftright(p, b).bitwiseAND(F.lit(1)), b * len(keys) + i) for b in range(bits) for i, p in enumerate(places)]
    return reduce(Column.bitwiseOR, bit)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int, bits: int = BITS) -> None:
    """Write ``df`` to about ``files`` files along the curve over ``keys`` (numbers, dates or times), then the manifest.

    Rows of one place are cut further by the keys themselves, so a place that holds much of the table fills many files.
    """
    if len(keys) * bits > 62:
        raise ValueError(f"{len(keys)} keys of {bits} bits don't fit a 64-bit place")
    placed = df.withColumn("_place", curve_place(df, keys, bits))
    placed.repartitionByRange(files, "_place", *keys).sortWithinPartitions("_place", *keys).drop("_place").write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("_file")
    ranges = [f(F.col(k)).alias(f"{end}_{k}") for k in keys for end, f in (("min", F.min), ("max", F.max))]
    rows.select(name, *keys).groupBy("_file").agg(F.count("*").alias("n_rows"), *ranges).coalesce(1).write.parquet(f"{path}_manifest")


def files_in(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> list[str]:
    """Names of the files that may hold rows with lo <= key <= hi for every key of ``ranges``."""
    if not exists(spark, f"{path}_manifest/_SUCCESS"):
        raise ValueError(f"{path} has no complete manifest")
    hit = [(F.col(f"max_{k}") >= F.lit(lo)) & (F.col(f"min_{k}") <= F.lit(hi)) for k, (lo, hi) in ranges.items()]
    found = spark.read.parquet(f"{path}_manifest").where(reduce(Column.__and__, hit, F.lit(True)))
    return sorted(r[0] for r in found.select("_file").collect())


def read_range(spark: SparkSession, path: str, schema: StructType, ranges: dict[str, tuple]) -> DataFrame:
    """The rows with lo <= key <= hi for every key of ``ranges``; files beside it are not opened."""
    files = files_in(spark, path, ranges)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files])
    return rows.where(reduce(Column.__and__, [F.col(k).between(F.lit(lo), F.lit(hi)) for k, (lo, hi) in ranges.items()], F.lit(True)))
