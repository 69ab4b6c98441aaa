"""The layer steps as pure DataFrame transforms: raw to bronze, silver and gold."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import rules as R

LINEAGE = ("_ingested_at_utc", "_ingestion_batch_id", "_source_file")
LOADED_AT = "_silver_loaded_at_utc"
BATCH_FORMAT = "yyyyMMdd'T'HHmmss'Z'"


def batch_id(at: datetime | None = None) -> str:
    """UTC instant as ``YYYYMMDDTHHMMSSZ``; taken once per run."""
    return (at or datetime.now(UTC)).astimezone(UTC).strftime("%Y%m%dT%H%M%SZ")


def batch_id_of(ts: str) -> str:
    """:func:`batch_id` of a timestamp column that holds UTC wall time."""
    return f'date_format({ts}, "{BATCH_FORMAT}")'


def _instant(at: datetime | None):
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def to_bronze(
    raw: DataFrame, batch: str, source_file: str | None = None, at: datetime | None = None
) -> DataFrame:
    """Raw columns untouched plus ingest time, batch id and source file.

    Without ``source_file`` the file each row was read from is recorded.
    """
    source = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return raw.select(
        *[F.col(f"`{c}`") for c in raw.columns],
        _instant(at).alias("_ingested_at_utc"),
        F.lit(batch).alias("_ingestion_batch_id"),
        source.alias("_source_file"),
    )


def to_silver(bronze: DataFrame, at: datetime | None = None) -> DataFrame:
    """Lineage dropped, money and pack sizes typed, load time stamped.

    A value that its type can't hold becomes NULL; ``quality.cast_rules`` finds such rows before a write.
    """
    return bronze.drop(*LINEAGE).withColumns(
        {
            LOADED_AT: _instant(at),
            "cost_price_aud": F.expr("try_cast(cost_price_aud as decimal(10,2))"),
            "retail_price_aud": F.expr("try_cast(retail_price_aud as decimal(10,2))"),
            "pack_size": F.expr("try_cast(pack_size as decimal(10,3))"),
        }
    )


def to_gold(silver: DataFrame) -> DataFrame:
    """Analytics columns: perishable, seasonal, price tier, margin."""
    months = "peak_season_months"
    return silver.drop(LOADED_AT).selectExpr(
        "*",
        "shelf_life_days is not null as is_perishable",
        f"{months} is not null and size({months}) > 0 as is_seasonal",
        f"{R.price_tier('retail_price_aud')} as price_tier",
        f"{R.margin_pct('retail_price_aud', 'cost_price_aud')} as margin_pct",
    )


def layer_stats(gold: DataFrame) -> DataFrame:
    """Row, perishable and seasonal counts in one pass."""
    return gold.selectExpr(
        "count(*) as n_rows",
        "count_if(is_perishable) as n_perishable",
        "count_if(is_seasonal) as n_seasonal",
    )
