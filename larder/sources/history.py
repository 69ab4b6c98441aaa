"""Dimension history on disk, partitioned by the day a version was closed.

Current versions form one partition (no closing day). A merge reads and replaces just that
partition and adds the one of its own day; versions closed earlier are neither read nor rewritten, and the last
closing day comes from the names of the partitions, so a merge costs as much as the current dimension, however
long the history grows. A merge is written whole to a journal beside the history first. A run that dies
after that is finished by the next one, whatever its day, before that does anything of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StructField, StructType

from larder.operators.history import open_history, scd2_merge
from larder.operators.quality import duplicate_keys
from larder.session import exists, folders, remove

CLOSED = "valid_to"


def _write(df: DataFrame, path: str) -> None:
    (
        df.drop("is_current")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(CLOSED)
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str, attributes: StructType) -> DataFrame:
    """All versions: the attributes (key included), valid_from, valid_to, is_current."""
    dates = [StructField("valid_from", DateType()), StructField(CLOSED, DateType())]
    versions = spark.read.schema(StructType([*attributes.fields, *dates])).parquet(path)
    return versions.selectExpr("*", f"{CLOSED} is null as is_current")


def start_history(snapshot: DataFrame, path: str, since: date) -> None:
    _write(open_history(snapshot, since), path)


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}_journal"


def _last_closed(spark: SparkSession, path: str) -> date | None:
    days = [f.partition("=")[2] for f in folders(spark, path) if f.startswith(f"{CLOSED}=")]
    return max((date.fromisoformat(d) for d in days if d[:1].isdigit()), default=None)


def finish_merge(spark: SparkSession, path: str, attributes: StructType) -> bool:
    """Carry out a merge that was written to the journal and no further; a journal that isn't complete is dropped.

    Closed versions come first; done again, each write replaces the same partitions by the same rows.
    """
    journal = _journal(path)
    if not exists(spark, journal):
        return False
    whole = exists(spark, f"{journal}/_SUCCESS")
    if whole:
        dates = [StructField("valid_from", DateType()), StructField(CLOSED, DateType())]
        flag = StructField("is_current", BooleanType())
        merged = spark.read.schema(StructType([*attributes.fields, *dates, flag])).parquet(journal)
        _write(merged.filter("not is_current").distinct(), path)
        _write(merged.filter("is_current"), path)
    remove(spark, journal)
    return whole


def merge_history(
    snapshot: DataFrame, path: str, key: str | Sequence[str], as_of: date
) -> None:
    """Merge a full snapshot taken on ``as_of`` into the history at ``path``.

    Refused are an empty snapshot, one that repeats a key, and a day before the last merge. Versions already closed on that day are kept, so several
    snapshots a day are fine and a repeated one changes nothing. One merge of a history runs at a time.
    """
    spark = snapshot.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    if repeated := duplicate_keys(snapshot, keys).limit(5).collect():
        raise ValueError(f"the snapshot repeats keys: {[tuple(r)[:-1] for r in repeated]}")
    finish_merge(spark, path, snapshot.schema)
    history = read_history(spark, path, snapshot.schema)
    current = history.filter(f"{CLOSED} is null")
    opened, closed = current.agg(F.max("valid_from")).first()[0], _last_closed(spark, path)
    if any(d is not None and as_of < d for d in (opened, closed)):
        raise ValueError(f"{as_of} lies before the last merge ({max(filter(None, (opened, closed)))})")
    closed_today = history.filter(F.col(CLOSED) == F.lit(as_of))
    merged = scd2_merge(current, snapshot, keys, as_of)
    columns = [*snapshot.columns, "valid_from", CLOSED, "is_current"]
    merged = merged.unionByName(closed_today.select(*merged.columns)).select(*columns)
    if snapshot.isEmpty():
        raise ValueError("the snapshot is empty; refusing to close the whole dimension")
    merged.write.mode("overwrite").parquet(_journal(path))
    finish_merge(spark, path, snapshot.schema)
