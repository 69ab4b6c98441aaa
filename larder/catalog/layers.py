"""Scans, sinks, projections and the layer run over product rows derived from ``part``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import query
from larder.catalog.check_sql import GOLD, PARTS, SILVER, TIER
from larder.functions import rules as R
from larder.operators import layers as L
from larder.operators import model as M
from larder.plans.layer_run import LayerConfig, run_layers
from larder.plans.part_products import read_landing_products, read_part_products
from larder.session import scratch
from larder.sources.landing import preview, read_landing, write_rows
from larder.sources.tables import ensure_schema, read_layer, write_layer

MONEY = ("cost_price_aud", "retail_price_aud")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.to_silver(read_landing_products(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.to_gold(_silver(spark, sf_dir))


def _new_schema(spark: SparkSession, name: str) -> str:
    """A schema of its own below the shared folder."""
    schema = f"larder_{name}_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, schema, scratch(spark, schema))
    return schema


@query(
    "scan_landing",
    "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part",
)
def scan_landing(spark, sf_dir):
    return read_landing(spark, f"{sf_dir}/part.parquet")


SILVER_COLUMNS = (
    "product_id, sku, name, department, category, subcategory, brand, is_private_label,"
    " unit_of_measure, pack_size, cost_price_aud, retail_price_aud, gst_applicable,"
    " shelf_life_days, wastage_rate_baseline, supplier_id"
)


@query("scan_layer_table", f"with {SILVER} select {SILVER_COLUMNS} from silver")
def scan_layer_table(spark, sf_dir):
    schema = _new_schema(spark, "scan")
    write_layer(_silver(spark, sf_dir), f"{schema}.dim_product")
    return read_layer(spark, schema, "dim_product").select(*SILVER_COLUMNS.split(", "))


@query(
    "bronze_merge_schema",
    """select p_partkey, p_name, p_size, null::varchar p_brand from part where false
       union all by name select p_partkey, p_size, p_brand from part""",
)
def bronze_merge_schema(spark, sf_dir):
    part = read_landing(spark, f"{sf_dir}/part.parquet")
    table = f"{_new_schema(spark, 'merge')}.part"
    write_layer(part.select("p_partkey", "p_name", "p_size"), table, evolve="merge")
    write_layer(part.select("p_partkey", "p_size", "p_brand"), table, evolve="merge")
    return spark.table(table)


@query("overwrite_schema", "select p_partkey, p_size, p_brand from part")
def overwrite_schema(spark, sf_dir):
    part = read_landing(spark, f"{sf_dir}/part.parquet")
    table = f"{_new_schema(spark, 'replace')}.part"
    write_layer(part.select("p_partkey", "p_name", "p_size"), table)
    write_layer(part.select("p_partkey", "p_size", "p_brand"), table)
    return spark.table(table)


@query(
    "write_parquet_roundtrip",
    f"""with {SILVER} select product_id, name, cast(cost_price_aud as double) cost_price_aud,
        case when season is not null or department = 'Fresh Produce' then
          case season when 'ice_cream' then '1,2,3,10,11,12' when 'barbecue' then '1,2,3,10,11,12'
            when 'easter' then '3,4,12' when 'christmas' then '10,11,12' else '' end end as months
        from silver""",
)
def write_parquet_roundtrip(spark, sf_dir):
    path = write_rows(read_landing_products(spark, sf_dir), scratch(spark, "rows"))
    return spark.read.parquet(path).selectExpr(
        "product_id", "name", "cost_price_aud", "array_join(peak_season_months, ',') as months"
    )


@query(
    "preview_topk",
    f"""with {SILVER} select product_id, name, department, retail_price_aud from silver
        order by product_id limit 10""",
)
def preview_topk(spark, sf_dir):
    rows = _silver(spark, sf_dir).select("product_id", "name", "department", "retail_price_aud")
    return preview(rows, 10, "product_id")


MODEL_SQL = ", ".join(name for name, _, _ in M.model_columns())


@query("model_scan", f"with {GOLD} select {MODEL_SQL} from gold")
def model_scan(spark, sf_dir):
    schema = _new_schema(spark, "model")
    write_layer(_gold(spark, sf_dir), f"{schema}.dim_product")
    return M.create_model_view(spark, f"{schema}.dim_product", f"{schema}.model")


@query("model_projection", f"with {GOLD} select {MODEL_SQL} from gold")
def model_projection(spark, sf_dir):
    return M.model_projection(_gold(spark, sf_dir))


@query(
    "bronze_lineage",
    """select event_id, user_id, event_type, value, '20240131T000000Z' _ingestion_batch_id,
       'events.parquet' _source_file from events""",
)
def bronze_lineage(spark, sf_dir):
    events = read_landing(spark, f"{sf_dir}/events.parquet")
    lined = L.to_bronze(events, "20240131T000000Z")
    return lined.select(
        "event_id", "user_id", "event_type", "value", "_ingestion_batch_id", "_source_file"
    )


@query(
    "batch_id_format",
    "select event_id, strftime(ts, '%Y%m%dT%H%M%SZ') batch_id from events",
)
def batch_id_format(spark, sf_dir):
    events = read_landing(spark, f"{sf_dir}/events.parquet")
    return events.selectExpr("event_id", f"{L.batch_id_of('ts')} as batch_id")


@query("drop_lineage", "select event_id, ts, user_id, event_type, value, props from events")
def drop_lineage(spark, sf_dir):
    events = read_landing(spark, f"{sf_dir}/events.parquet")
    lined = L.to_bronze(events, "20240131T000000Z", "events.parquet")
    return lined.drop(*L.LINEAGE, "_absent_column")


@query(
    "silver_casts",
    f"""with {SILVER} select product_id, cost_price_aud, retail_price_aud, pack_size from silver""",
)
def silver_casts(spark, sf_dir):
    return _silver(spark, sf_dir).select("product_id", *MONEY, "pack_size")


@query(
    "gold_is_perishable", f"with {GOLD} select product_id, shelf_life_days, is_perishable from gold"
)
def gold_is_perishable(spark, sf_dir):
    return _gold(spark, sf_dir).select("product_id", "shelf_life_days", "is_perishable")


@query("gold_is_seasonal", f"with {GOLD} select product_id, is_seasonal from gold")
def gold_is_seasonal(spark, sf_dir):
    return _gold(spark, sf_dir).select("product_id", "is_seasonal")


# Every 50th price is removed first: a missing price is Premium.
@query(
    "gold_price_tier",
    f"""with {PARTS}, priced as (
          select k, case when k % 50 <> 0 then retail end retail_price_aud from parts)
        select k, retail_price_aud, {TIER} price_tier from priced""",
)
def gold_price_tier(spark, sf_dir):
    rows = read_part_products(spark, sf_dir)
    rows = rows.selectExpr("k", "if(k % 50 <> 0, retail, null) as retail_price_aud")
    return rows.selectExpr("*", f"{R.price_tier('retail_price_aud')} as price_tier")


# Every 40th price is zero and every 30th cost absurd: both margins are NULL.
@query(
    "gold_margin_pct",
    f"""with {PARTS}, priced as (
          select k, cast(case when k % 40 = 0 then 0 else retail end as decimal(10,2)) retail_price_aud,
            cast(case when k % 30 = 7 then cost + 100000 else cost end as decimal(10,2)) cost_price_aud
          from parts)
        select k, case when retail_price_aud = 0 then null
          else try_cast((retail_price_aud - cost_price_aud) / retail_price_aud * 100
            as decimal(5,2)) end margin_pct from priced""",
)
def gold_margin_pct(spark, sf_dir):
    rows = read_part_products(spark, sf_dir).selectExpr(
        "k",
        "cast(if(k % 40 = 0, 0BD, retail) as decimal(10,2)) as retail_price_aud",
        "cast(if(k % 30 = 7, cost + 100000, cost) as decimal(10,2)) as cost_price_aud",
    )
    return rows.selectExpr("k", f"{R.margin_pct('retail_price_aud', 'cost_price_aud')} as margin_pct")


@query("filter_perishable", f"with {GOLD} select product_id, category from gold where is_perishable")
def filter_perishable(spark, sf_dir):
    return _gold(spark, sf_dir).filter("is_perishable").select("product_id", "category")


@query(
    "filter_null_key",
    "select nullif(p_partkey, p_size) as product_key, p_size from part where nullif(p_partkey, p_size) is null",
)
def filter_null_key(spark, sf_dir):
    part = read_landing(spark, f"{sf_dir}/part.parquet")
    keyed = part.selectExpr("nullif(p_partkey, p_size) as product_key", "p_size")
    return keyed.filter(F.col("product_key").isNull())


@query(
    "layers_end_to_end",
    f"""with {GOLD} select department, price_tier, count(*) n_products,
        count_if(is_perishable)::bigint n_perishable, count_if(is_seasonal)::bigint n_seasonal,
        cast(sum(retail_price_aud) as decimal(18,2)) sum_retail,
        cast(sum(margin_pct) as decimal(18,2)) sum_margin
        from gold group by department, price_tier""",
)
def layers_end_to_end(spark, sf_dir):
    tag = uuid.uuid4().hex[:8]
    cfg = LayerConfig(
        landing=f"{sf_dir}/part.parquet",
        bronze=f"larder_bronze_{tag}",
        silver=f"larder_silver_{tag}",
        gold=f"larder_gold_{tag}",
        location=scratch(spark, "layers"),
        expected_rows=None,
        full_rules=True,
    )
    run_layers(spark, cfg, read_landing_products(spark, sf_dir))
    gold = read_layer(spark, cfg.gold, cfg.table)
    return gold.groupBy("department", "price_tier").agg(
        F.count("*").alias("n_products"),
        F.count_if("is_perishable").alias("n_perishable"),
        F.count_if("is_seasonal").alias("n_seasonal"),
        F.expr("cast(sum(retail_price_aud) as decimal(18,2))").alias("sum_retail"),
        F.expr("cast(sum(margin_pct) as decimal(18,2))").alias("sum_margin"),
    )
