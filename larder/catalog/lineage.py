"""Column lineage of the layer tables, facts joined to the dimension version of their time, late changes."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from larder.catalog import query
from larder.operators import changes as CH
from larder.operators.valid import join_valid
from larder.plans.layer_run import LayerConfig, read_lineage, run_layers
from larder.plans.part_products import read_landing_products
from larder.session import scratch
from larder.sources.history import merge_history, read_history, start_history
from larder.sources.tables import read_layer

# The gold table's columns by hand: those that silver hands on, then the derived ones and what they are made from.
_HANDED_ON = """product_id sku name department category subcategory brand is_private_label unit_of_measure pack_size
  cost_price_aud retail_price_aud gst_applicable shelf_life_days peak_season_months seasonality_vector
  wastage_rate_baseline supplier_id""".split()
_DERIVED = (
    ("is_perishable", "shelf_life_days", 18),
    ("is_seasonal", "peak_season_months", 19),
    ("price_tier", "retail_price_aud", 20),
    ("margin_pct", "cost_price_aud", 21),
    ("margin_pct", "retail_price_aud", 21),
)
GOLD_EDGES = [(c, c, i) for i, c in enumerate(_HANDED_ON)] + list(_DERIVED)
_EDGE_ROWS = ", ".join(f"('{out}', '{src}', {place})" for out, src, place in GOLD_EDGES)


@query(
    "column_lineage",
    f"""select output_column, source_column, position, (select count(*) from part) n_rows
        from (values {_EDGE_ROWS}) e(output_column, source_column, position)""",
)
def column_lineage(spark, sf_dir):
    """The gold table's edges as its layer run wrote them, with the rows that the table holds."""
    tag = uuid.uuid4().hex[:8]
    names = {layer: f"lineage_{layer}_{tag}" for layer in ("bronze", "silver", "gold")}
    cfg = LayerConfig(
        landing=f"{sf_dir}/part.parquet", location=scratch(spark, "lineage"), expected_rows=None, gates=False, **names
    )
    run_layers(spark, cfg, read_landing_products(spark, sf_dir))
    n = read_layer(spark, cfg.gold, cfg.table).agg(F.count("*").alias("n_rows")).scalar()
    edges = read_lineage(spark, cfg, cfg.gold).where(F.col("source_table") == f"{cfg.silver}.{cfg.table}")
    return edges.select("output_column", "source_column", "position", n.alias("n_rows"))


_FIRST, _SECOND = date(1997, 1, 1), date(1999, 6, 1)


@query(
    "point_in_time_orders",
    f"""with o as (select *, o_orderdate::date d from orders),
        j as (select o.*, case when d < date '{_FIRST}' then case when c_custkey % 10 <> 3 then c_mktsegment end
            when d < date '{_SECOND}' then case when c_custkey % 11 <> 5 then if(c_acctbal > 5000, 'VIP', c_mktsegment) end
            else if(c_acctbal < 0, 'AT RISK', c_mktsegment) end seg
          from o left join customer on o_custkey = c_custkey)
        select coalesce(seg, 'none') segment, year(d)::integer as year, count(*) n_orders,
          cast(sum(cast(o_totalprice as decimal(14,2))) as decimal(22,2)) total from j group by all""",
)
def point_in_time_orders(spark, sf_dir):
    """Orders by the segment their customer had on the day of the order; the dimension has versions of three snapshots."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    path = scratch(spark, "customer-versions")
    first = customer.where("c_custkey % 10 <> 3").select("c_custkey", "c_mktsegment")
    start_history(first, path, date(1992, 1, 1))
    second = customer.where("c_custkey % 11 <> 5")
    merge_history(second.selectExpr("c_custkey", "if(c_acctbal > 5000, 'VIP', c_mktsegment) as c_mktsegment"), path, "c_custkey", _FIRST)
    third = customer.selectExpr("c_custkey", "if(c_acctbal < 0, 'AT RISK', c_mktsegment) as c_mktsegment")
    merge_history(third, path, "c_custkey", _SECOND)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    joined = join_valid(orders, read_history(spark, path, first.schema), {"o_custkey": "c_custkey"}, "o_orderdate", ["c_mktsegment"])
    return joined.groupBy(F.coalesce("c_mktsegment", F.lit("none")).alias("segment"), F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n_orders"),
        F.sum(F.expr("cast(o_totalprice as decimal(14,2))")).cast("decimal(22,2)").alias("total"),
    )


_STATE = "valid_from, valid_to, user_id, event_type, value"


def _known_sql(upto: int) -> str:
    """What holds when, after the batches up to ``upto``."""
    return f"""select {upto} as b, valid_from, lead(valid_from) over (partition by user_id order by valid_from) valid_to,
            user_id, event_type, value, gone
          from (select *, lag(gone) over w lg, lag(event_type) over w le, lag(value) over w lv, row_number() over w i
            from (select * from feed where arrival <= {upto} qualify row_number() over (
                partition by user_id, valid_from order by arrival desc, gone desc, event_type desc nulls last, value desc nulls last) = 1)
            window w as (partition by user_id order by valid_from))
          where (not gone or i > 1) and not (i > 1 and ((gone and lg) or (not gone and not lg and event_type is not distinct from le and value is not distinct from lv)))"""


@query(
    "late_changes",
    f"""with feed as (select user_id, event_type, cast(value as decimal(12,2)) as value, date_trunc('hour', ts) valid_from,
            (event_id * 7919 % 3 + 1)::integer arrival, event_type = 'error' gone from events),
        snaps as ({" union all ".join(f"({_known_sql(b)})" for b in (1, 2, 3))}),
        held as (select * exclude (gone) from snaps where not gone),
        isles as (select *, b - row_number() over (partition by {_STATE} order by b) isle from held)
        select user_id, event_type, value, strftime(valid_from, '%Y-%m-%d %H') since, strftime(valid_to, '%Y-%m-%d %H') until,
          min(b)::integer known_from, case when max(b) < 3 then max(b) + 1 end::integer known_to
        from isles group by {_STATE}, isle""",
)
def late_changes(spark, sf_dir):
    """The last event of every user by hour, with errors as deletes, arriving in three batches in disorder."""
    feed = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "user_id", "event_type", "cast(value as decimal(12,2)) as value", "date_trunc('hour', ts) as event_time",
        "cast(event_id * 7919 % 3 + 1 as int) as arrival", "event_type = 'error' as is_deleted",
    )
    keys, attributes = ["user_id"], ["event_type", "value"]
    known = CH.empty_history(feed, keys, attributes)
    for batch in (1, 2, 3):
        path = scratch(spark, f"known-{batch}")
        CH.merge_arrivals(known, feed, keys, attributes, batch).write.parquet(path)
        known = spark.read.schema(known.schema).parquet(path)
    hour = "yyyy-MM-dd HH"
    return known.select(
        "user_id", "event_type", "value", F.date_format("valid_from", hour).alias("since"),
        F.date_format("valid_to", hour).alias("until"), "known_from", "known_to",
    )
