"""Layer tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def read_layer(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.table(f"{layer}.{table}")


def merged(df: DataFrame, old: StructType) -> DataFrame:
    """``df`` with the columns only the old schema has, as typed NULLs in front of new columns.

    The same column name with another type is an error.
    """
    new = {f.name: f.dataType for f in df.schema}
    for f in old:
        if f.name in new and new[f.name] != f.dataType:
            raise TypeError(
                f"column {f.name} was {f.dataType.simpleString()},"
                f" is {new[f.name].simpleString()} now"
            )
    kept = [
        F.col(f"`{f.name}`") if f.name in new else F.lit(None).cast(f.dataType).alias(f.name)
        for f in old
    ]
    known = {f.name for f in old}
    return df.select(*kept, *[F.col(f"`{c}`") for c in df.columns if c not in known])


def _versions(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def write_layer(
    df: DataFrame, table: str, evolve: str = "replace", partition_by: Sequence[str] = ()
) -> None:
    """Replace the content of ``table``.

    ``evolve="merge"`` keeps columns of earlier schemas (filled with NULL); ``"replace"`` takes the
    new schema. ``table`` is a view over the last complete version. A write makes a version of its own
    name and then points the view at it in one catalogue operation: there is no moment without a table,
    a run that dies leaves the old content, parallel runs don't meet, and ``df`` may itself read
    ``table``. The version before stays for readers that have begun; the one before that is dropped.
    """
    if evolve not in ("merge", "replace"):
        raise ValueError(f"evolve must be merge or replace, not {evolve!r}")
    spark = df.sparkSession
    there = spark.catalog.tableExists(table)
    if there and evolve == "merge":
        df = merged(df, spark.table(table).schema)
    known = _versions(spark, table) if there else {}
    version = f"{table}__{uuid.uuid4().hex[:12]}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(version)
    old = known.get("larder.version", "")
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('larder.version' = '{version}',"
        f" 'larder.before' = '{old}') AS SELECT * FROM {version}"
    )
    if gone := known.get("larder.before"):
        spark.sql(f"DROP TABLE IF EXISTS {gone}")
