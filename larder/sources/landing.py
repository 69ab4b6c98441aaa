"""Landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A landed Parquet file or folder."""
    return spark.read.parquet(path)


def write_rows(df: DataFrame, path: str) -> str:
    """Write typed rows as Parquet, replacing what is there; returns the path.

    Arrays stay arrays. The result is a folder with one file per task, so nothing is funnelled
    through one writer.
    """
    df.write.mode("overwrite").parquet(path)
    return path


def preview(df: DataFrame, k: int, *order: str) -> DataFrame:
    """The first ``k`` rows in ``order``: a top-k, each task keeps k rows, nothing is fully sorted."""
    return df.orderBy(*order).limit(k)
