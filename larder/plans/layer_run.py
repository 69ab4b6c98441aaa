"""The layer run: bronze, silver, gold, each only after the former succeeded."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators import layers as L
from larder.operators.lineage import lineage_table, trace
from larder.operators import quality as Q
from larder.sources.landing import read_landing
from larder.sources.tables import ensure_schema, read_layer, write_layer


@dataclass(frozen=True)
class LayerConfig:
    landing: str
    table: str = "dim_product"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    location: str | None = None  # folder of the schemas; None keeps the warehouse default
    expected_rows: int | None = 2000
    full_rules: bool = True  # False leaves the key checks of the silver gate alone
    gates: bool = True
    lineage: bool = True  # a table of column edges beside each layer's table
    at: datetime | None = None  # run time; None takes the clock

    def schema_location(self, schema: str) -> str | None:
        return f"{self.location}/{schema}" if self.location else None


@dataclass(frozen=True)
class LayerReport:
    batch: str
    n_rows: int
    n_perishable: int
    n_seasonal: int


def _write_lineage(df: DataFrame, cfg: LayerConfig, schema: str) -> None:
    """The layer's column edges as a table beside it."""
    if cfg.lineage:
        write_layer(lineage_table(df).coalesce(1), f"{schema}.{cfg.table}_lineage")


def read_lineage(spark: SparkSession, cfg: LayerConfig, schema: str) -> DataFrame:
    """The edges that the last run of a layer wrote, with the table they lead to."""
    edges = read_layer(spark, schema, f"{cfg.table}_lineage")
    return edges.withColumn("output_table", F.lit(f"{schema}.{cfg.table}"))


def trace_to_landing(spark: SparkSession, cfg: LayerConfig) -> DataFrame:
    """Every gold column with the landing columns it comes from, and the steps between them."""
    gold, silver, bronze = (read_lineage(spark, cfg, s) for s in (cfg.gold, cfg.silver, cfg.bronze))
    return trace(gold, silver, bronze)


def run_bronze(spark: SparkSession, cfg: LayerConfig, raw: DataFrame | None = None) -> str:
    batch = L.batch_id(cfg.at)
    raw = read_landing(spark, cfg.landing) if raw is None else raw
    if cfg.gates:
        if raw.isEmpty():
            raise Q.GateFailed("bronze gate: no rows")
        if (suite := Q.bronze_suite(raw)).rows:
            Q.enforce(Q.check_suite(raw, suite), "bronze gate")
    ensure_schema(spark, cfg.bronze, cfg.schema_location(cfg.bronze))
    bronze = L.to_bronze(raw, batch, cfg.landing, cfg.at)
    write_layer(bronze, f"{cfg.bronze}.{cfg.table}", evolve="merge")
    _write_lineage(bronze, cfg, cfg.bronze)
    return batch


def run_silver(spark: SparkSession, cfg: LayerConfig) -> None:
    """Gate first, then write: a failed rule raises and leaves the silver table as it was."""
    bronze = read_layer(spark, cfg.bronze, cfg.table)
    silver = L.to_silver(bronze, cfg.at)
    if cfg.gates:
        Q.enforce(Q.check_rows(bronze, Q.cast_rules()), "silver gate")
        suite = Q.silver_suite(cfg.expected_rows, cfg.full_rules)
        Q.enforce(Q.check_suite(silver, suite), "silver gate")
    ensure_schema(spark, cfg.silver, cfg.schema_location(cfg.silver))
    write_layer(silver, f"{cfg.silver}.{cfg.table}")
    _write_lineage(silver, cfg, cfg.silver)


def run_gold(spark: SparkSession, cfg: LayerConfig) -> dict:
    """Gate, then write; the counts are observed while writing, not by scanning again."""
    gold = made = L.to_gold(read_layer(spark, cfg.silver, cfg.table))
    if cfg.gates:
        Q.enforce(Q.check_suite(gold, Q.gold_suite()), "gold gate")
    stats = Observation(f"gold {cfg.table}")
    gold = gold.observe(
        stats,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("is_perishable").alias("n_perishable"),
        F.count_if("is_seasonal").alias("n_seasonal"),
    )
    ensure_schema(spark, cfg.gold, cfg.schema_location(cfg.gold))
    write_layer(gold, f"{cfg.gold}.{cfg.table}")
    _write_lineage(made, cfg, cfg.gold)
    return stats.get


def run_layers(
    spark: SparkSession, cfg: LayerConfig, raw: DataFrame | None = None
) -> LayerReport:
    batch = run_bronze(spark, cfg, raw)
    run_silver(spark, cfg)
    return LayerReport(batch, **run_gold(spark, cfg))
