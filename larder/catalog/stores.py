"""Lead times, stored totals, dense keys, the clustered layout and drift between batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from larder.catalog import query
from larder.operators import drift as D
from larder.operators import leadtime as LT
from larder.operators.totals import month_brand_deltas
from larder.session import scratch
from larder.sources import clustered as C
from larder.sources.keys import add_keys, read_keys
from larder.sources.partitioned import read_partitions, write_partitions
from larder.sources.totals import Totals


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "supplier_lead_times",
    """select l_suppkey, count(*) n_lines, count(*) filter (d is null) n_undated, count(*) filter (d < 0) n_early,
          quantile_disc(d, 0.5)::bigint p50_days, quantile_disc(d, 0.9)::bigint p90_days
        from (select l_suppkey, date_diff('day', o_orderdate::date, l_shipdate::date) d
          from lineitem left join orders on l_orderkey = o_orderkey) group by all""",
)
def supplier_lead_times(spark, sf_dir):
    """Counts of days by lead, stored by month, merged per supplier. Exact at any size."""
    daily = LT.daily_counts(LT.lead_days(_read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "orders")))
    daily = daily.withColumn("ship_month", F.date_format("ship_day", "yyyy-MM"))
    stored = write_partitions(daily, scratch(spark, "lead-times"), ["ship_month"])
    days = read_partitions(spark, stored, daily.schema)
    return LT.count_quantiles(LT.merged_counts(days, ["l_suppkey"]), ["l_suppkey"], {"p50_days": 0.5, "p90_days": 0.9})


@query(
    "stored_totals",
    """select strftime(l_shipdate, '%Y-%m') ship_month, p_brand, count(*) n_lines,
          cast(sum(cast(l_quantity as decimal(12,2))) as decimal(18,2)) quantity,
          cast(sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))) as decimal(22,4)) revenue
        from lineitem left join part on l_partkey = p_partkey group by all""",
)
def stored_totals(spark, sf_dir):
    """Four increments by order, one of them twice, the first two folded in between and one of those sent again."""
    lines, part = _read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "part")
    batches = [month_brand_deltas(lines.where(F.coalesce(F.col("l_orderkey") % 4, F.lit(0)) == b), part) for b in range(4)]
    store = Totals(spark, scratch(spark, "totals"), batches[0].schema, ["ship_year", "ship_month", "p_brand"], ["orders"])
    for b in (0, 1, 1):
        store.add(batches[b], b)
    store.fold(1)
    for b in (0, 2, 3):
        store.add(batches[b], b)
    return store.read().drop("ship_year", "orders")


@query(
    "dense_keys",
    """with firsts as (select o_custkey, min(case when year(o_orderdate) < 1997 then 1 when year(o_orderdate) < 2000 then 2 else 3 end) load
          from orders group by 1),
        sizes as (select load, count(*) n_new from firsts group by 1)
        select load, n_new, (sum(n_new) over (order by load) - n_new + 1)::bigint first_key,
          (sum(n_new) over (order by load))::bigint last_key, n_new n_numbers from sizes""",
)
def dense_keys(spark, sf_dir):
    """Customers numbered in three loads of orders, the second one twice: each load's numbers follow on the ones before."""
    year = F.year("o_orderdate")
    orders = _read(spark, sf_dir, "orders").select("o_custkey", F.when(year < 1997, 1).when(year < 2000, 2).otherwise(3).alias("load"))
    path = scratch(spark, "dense-keys")
    for load in (1, 2, 2, 3):
        add_keys(orders.where(F.col("load") == load), path, ["o_custkey"])
    keys = read_keys(spark, path, orders.select("o_custkey").schema)
    firsts = orders.groupBy("o_custkey").agg(F.min("load").alias("load"))
    same = firsts["o_custkey"].eqNullSafe(keys["o_custkey"])
    return firsts.join(keys, same).groupBy("load").agg(
        F.count("*").alias("n_new"), F.min("dense_key").alias("first_key"), F.max("dense_key").alias("last_key"),
        F.countDistinct("dense_key").alias("n_numbers"),
    )


@query(
    "clustered_range",
    """select l_suppkey, count(*) n_lines, cast(sum(cast(l_quantity as decimal(12,2))) as decimal(18,2)) quantity
        from lineitem where l_suppkey between 3 and 30
          and l_shipdate between timestamp '1996-03-01' and timestamp '1996-09-30' group by all""",
)
def clustered_range(spark, sf_dir):
    """Lines along a curve over supplier and shipping time, of which a range over both is read."""
    lines = _read(spark, sf_dir, "lineitem")
    path = scratch(spark, "clustered")
    C.write_clustered(lines, path, ["l_suppkey", "l_shipdate"], 64)
    span = (datetime(1996, 3, 1), datetime(1996, 9, 30))
    rows = C.read_range(spark, path, lines.schema, {"l_suppkey": (3, 30), "l_shipdate": span})
    return rows.groupBy("l_suppkey").agg(
        F.count("*").alias("n_lines"), F.expr("cast(sum(cast(l_quantity as decimal(12,2))) as decimal(18,2))").alias("quantity")
    )


# Two batches by year; in the second one quantities move up and some flags are missing.
_SHIFTED = {"l_quantity": "l_quantity * 1.5", "l_returnflag": "nullif(l_returnflag, case when l_orderkey % 4 = 0 then 'A' end)"}


@query(
    "batch_drift",
    """with a as (select l_quantity::double q, l_returnflag r, l_discount d from lineitem where year(l_shipdate) = 1996),
        b as (select l_quantity * 1.5 q, nullif(l_returnflag, case when l_orderkey % 4 = 0 then 'A' end) r, l_discount d
          from lineitem where year(l_shipdate) = 1997),
        cuts as (select list_sort(list_distinct(quantile_disc(q, [.1, .2, .3, .4, .5, .6, .7, .8, .9]))) q,
          list_sort(list_distinct(quantile_disc(d, [.1, .2, .3, .4, .5, .6, .7, .8, .9]))) d from a),
        common as (select list(r order by n desc, r) r from (select r, count(*) n from a where r is not null group by 1)),
        cells as (select s, unnest([
            {'name': 'l_quantity', 'bin': case when t.q is null then 0 else 1 + len(list_filter(cuts.q, lambda e: e < t.q)) end},
            {'name': 'l_discount', 'bin': case when t.d is null then 0 else 1 + len(list_filter(cuts.d, lambda e: e < t.d)) end},
            {'name': 'l_returnflag', 'bin': case when t.r is null then 0 else coalesce(list_position(common.r, t.r), len(common.r) + 1) end}]) c
          from (select 'a' s, * from a union all select 'b', * from b) t, cuts, common),
        bins as (select 'l_quantity' as name, unnest(range(len(q) + 2)) bin from cuts union all
          select 'l_discount', unnest(range(len(d) + 2)) from cuts union all select 'l_returnflag', unnest(range(len(r) + 2)) from common),
        n as (select name, bin, count(s) filter (s = 'a') a, count(s) filter (s = 'b') b
          from bins left join (select s, c.name as name, c.bin as bin from cells) using (name, bin) group by all),
        told as (select name, bin, (a + 0.5::double) / (sum(a) over w + 0.5::double * count(*) over w) pa,
            (b + 0.5::double) / (sum(b) over w + 0.5::double * count(*) over w) pb,
            sum(a) filter (bin > 0) over (w order by bin) / (sum(a) filter (bin > 0) over w)::double ca,
            sum(b) filter (bin > 0) over (w order by bin) / (sum(b) filter (bin > 0) over w)::double cb,
            a / (sum(a) over w)::double na, b / (sum(b) over w)::double nb from n window w as (partition by name)),
        sums as (select name, sum((pb - pa) * ln(pb / pa)) psi, max(abs(cb - ca)) ks,
          max(abs(nb - na)) filter (bin = 0) null_change from told group by all)
        select name, round(psi, 6) psi, case when name <> 'l_returnflag' then round(ks, 6) end ks, round(null_change, 6) null_change,
          psi <= 0.2 and (name = 'l_returnflag' or ks <= 0.15) and null_change <= 0.05 passed from sums""",
)
def batch_drift(spark, sf_dir):
    """How far one year's lines, spoiled in two columns, have drifted from the year before."""
    lines = _read(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    gate = D.DriftGate(spark, scratch(spark, "profiles"), ["l_quantity", "l_discount"], ["l_returnflag"])
    gate.check(lines.where(year == 1996), 1996)
    later = lines.where(year == 1997).withColumns({c: F.expr(e) for c, e in _SHIFTED.items()})
    rounded = [F.round(c, 6).alias(c) for c in ("psi", "ks", "null_change")]
    return gate.report(later, 1997).select("name", *rounded, "passed")
