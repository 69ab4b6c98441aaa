"""Folders partitioned by date and domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from larder.session import exists


def write_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Write ``df`` partitioned by ``keys``; only partitions that occur in ``df`` are replaced.

    Rows are rebalanced on the keys, so a partition gets few files; adaptive execution splits a
    partition that holds much of the data over several writers.
    """
    if exists(df.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a stream, whose log lists files this load would replace")
    balanced = df.hint("rebalance", *keys)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def read_partitions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows below ``path``. The schema names the types of the partition keys too: guessed from the
    folder names, a key such as ``007`` would become a number."""
    return spark.read.schema(schema).parquet(path)
