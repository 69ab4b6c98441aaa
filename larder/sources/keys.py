"""Dense surrogate keys: a stored map from natural keys to 1, 2, 3, ... without gaps.

New natural keys are dealt to slots by hash, numbered within their slot, and moved on by the counts of the slots before; so no
task sees more than a slot. What has a number keeps it. A load's numbers appear at once, with its complete folder, whose
name tells the last number; a load repeated, also after a crash, finds its keys numbered or does it again. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larder.session import exists, folders, remove, scratch

SLOTS = 4096


def _loads(spark: SparkSession, path: str) -> dict[int, str]:
    """Complete loads by their last number."""
    names = [n for n in folders(spark, path) if n.startswith("upto=")]
    return {int(n[5:]): f"{path}/{n}" for n in names if exists(spark, f"{path}/{n}/_SUCCESS")}


def read_keys(spark: SparkSession, path: str, natural: StructType, out: str = "dense_key") -> DataFrame:
    """The map: the natural key's columns, as ``natural`` types them, and the number."""
    schema = StructType([*natural, StructField(out, LongType())])
    loads = sorted(_loads(spark, path).values())
    return spark.read.schema(schema).parquet(*loads) if loads else spark.createDataFrame([], schema)


def add_keys(rows: DataFrame, path: str, natural: Sequence[str], out: str = "dense_key", slots: int = SLOTS) -> int:
    """Number the natural keys of ``rows`` that have no number yet; returns how many. NULL is a value like any other."""
    spark = rows.sparkSession
    named = rows.select(*natural)
    known = read_keys(spark, path, named.schema, out).select(*[F.col(c).alias(f"_known_{c}") for c in natural])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in natural]
    fresh = named.distinct().join(known, same, "left_anti")
    # Counted and numbered from one written table, whatever becomes of the source in between.
    stage = scratch(spark, "new-keys")
    fresh.withColumn("_slot", F.pmod(F.xxhash64(*natural), F.lit(slots)).cast("int")).write.parquet(stage)
    staged = spark.read.parquet(stage)
    counts = sorted((r["_slot"], r["count"]) for r in staged.groupBy("_slot").count().collect())  # at most ``slots`` rows
    total, last = sum(n for _, n in counts), max(_loads(spark, path), default=0)
    if total:
        before = accumulate((n for _, n in counts), initial=last)
        offsets = spark.createDataFrame([(s, b) for (s, _), b in zip(counts, before)], "_slot int, _before bigint")
        place = F.row_number().over(W.partitionBy("_slot").orderBy(*natural))
        numbered = staged.join(F.broadcast(offsets), "_slot").select(*natural, (F.col("_before") + place).alias(out))
        numbered.write.mode("overwrite").parquet(f"{path}/upto={last + total:018d}")
    remove(spark, stage)
    return total
