"""Incremental loads, history, star-schema and demand queries over the fact tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from larder.catalog import check_sql as S
from larder.catalog import query
from larder.operators import demand as DM
from larder.operators import history as H
from larder.operators import smoothing as SM
from larder.operators import star
from larder.operators.calendar import calendar_dim, holidays
from larder.plans.jobs import dated, job_backfill, job_daily
from larder.plans.part_products import read_part_products
from larder.session import scratch
from larder.sources.history import merge_history, read_history, start_history
from larder.sources.partitioned import read_partitions, write_partitions
from larder.streaming.incremental import load_new_files


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BY_DAY = (
    "cast(count(*) as bigint) as n_events",
    "cast(sum(cast(value as decimal(12,2))) as decimal(18,2)) as total_value",
)
_DAY_SQL = """count(*) n_events,
  cast(sum(cast(value as decimal(12,2))) as decimal(18,2)) total_value"""


# ---- loads -------------------------------------------------------------------------------------


@query(
    "backfill_range",
    f"""select strftime(ts, '%Y-%m-%d') as day_key, event_type, {_DAY_SQL}
        from events group by all""",
)
def backfill_range(spark, sf_dir):
    """Two overlapping backfills and one day again: shared days are replaced, not doubled."""
    events = _read(spark, sf_dir, "events")
    out = scratch(spark, "backfill")
    job_backfill(events, date(1970, 1, 1), date(2024, 1, 20), out)
    job_backfill(events, date(2024, 1, 15), date(2099, 12, 31), out)
    job_daily(events, date(2024, 1, 15), out)
    rows = read_partitions(spark, out, dated(events).schema).selectExpr(
        "cast(event_date as string) as day_key", "event_type", "value"
    )
    return rows.groupBy("day_key", "event_type").agg(*[F.expr(e) for e in _BY_DAY])


@query(
    "daily_increment",
    f"select strftime(ts, '%Y-%m-%d') as day_key, {_DAY_SQL} from events group by all",
)
def daily_increment(spark, sf_dir):
    """The events as a bounded stream; a second run finds nothing new."""
    out, checkpoint = scratch(spark, "daily"), scratch(spark, "daily-checkpoint")
    schema = _read(spark, sf_dir, "events").schema
    for _ in range(2):
        load_new_files(spark, sf_dir, schema, out, checkpoint, files="events.parquet")
    rows = spark.read.schema(schema).parquet(out)
    rows = rows.selectExpr("date_format(ts, 'yyyy-MM-dd') as day_key", "value")
    return rows.groupBy("day_key").agg(*[F.expr(e) for e in _BY_DAY])


@query(
    "partitioned_scan",
    f"""select strftime(ts, '%Y-%m-%d') as day_key, lpad((user_id % 10)::varchar, 3, '0') as domain,
          user_id % 7 as user_group, {_DAY_SQL}
        from events where user_id % 10 < 8 and ts >= timestamp '2024-01-10' group by all""",
)
def partitioned_scan(spark, sf_dir):
    """Partitions by date and a text domain with leading zeros; reads just some domains from a date on."""
    events = dated(_read(spark, sf_dir, "events"))
    events = events.withColumn("domain", F.expr("lpad(cast(user_id % 10 as string), 3, '0')"))
    out = write_partitions(events, scratch(spark, "events"), ["event_date", "domain"])
    rows = read_partitions(spark, out, events.schema).filter(
        "domain < '008' and event_date >= date '2024-01-10'"
    )
    rows = rows.selectExpr(
        "cast(event_date as string) as day_key", "domain", "user_id % 7 as user_group", "value"
    )
    return rows.groupBy("day_key", "domain", "user_group").agg(*[F.expr(e) for e in _BY_DAY])


# ---- history -----------------------------------------------------------------------------------

_LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus, l_shipdate"
)


@query(
    "dedup_latest",
    f"""select {_LINE_COLUMNS} from lineitem qualify row_number() over (
          partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc,
            l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc,
            l_returnflag desc, l_linestatus desc) = 1""",
)
def dedup_latest(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS.split(", "))
    return H.dedup_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# Every 50th order names a customer that doesn't exist.
@query(
    "surrogate_keys",
    """select coalesce(c_mktsegment, 'unknown') segment, count(*) n_orders,
         count(distinct c_custkey) n_customers,
         cast(sum(cast(o_totalprice as decimal(14,2))) as decimal(22,2)) total
       from (select *, case when o_orderkey % 50 = 7 then -o_custkey - 1 else o_custkey end as cust from orders)
       left join customer on cust = c_custkey
       group by 1""",
)
def surrogate_keys(spark, sf_dir):
    dim = H.with_surrogate_key(_read(spark, sf_dir, "customer"), ["c_custkey"], "customer_sk")
    orders = _read(spark, sf_dir, "orders")
    orders = orders.withColumn("o_custkey", F.expr("if(o_orderkey % 50 = 7, -o_custkey - 1, o_custkey)"))
    facts = H.swap_keys(orders, dim, {"o_custkey": "c_custkey"}, "customer_sk")
    per_key = facts.groupBy("customer_sk").agg(
        F.count("*").alias("n"),
        F.sum(F.expr("cast(o_totalprice as decimal(14,2))")).alias("total"),
    )
    out = per_key.join(dim.select("customer_sk", "c_mktsegment"), "customer_sk", "left")
    return out.groupBy(F.expr("coalesce(c_mktsegment, 'unknown')").alias("segment")).agg(
        F.sum("n").alias("n_orders"),
        F.count("c_mktsegment").alias("n_customers"),
        F.sum("total").cast("decimal(22,2)").alias("total"),
    )


_NEXT = """select c_custkey + case when c_nationkey = 0 then 100000000 else 0 end c_custkey, c_nationkey, c_name,
  case when c_acctbal < 0 then 'AT RISK' else c_mktsegment end c_mktsegment
  from customer where c_acctbal <= 9500"""


@query(
    "scd2_merge",
    f"""with nxt as ({_NEXT}), j as (
          select o.c_custkey ok, o.c_nationkey onat, n.c_nationkey nnat, o.c_name oname, o.c_mktsegment oseg,
            n.c_custkey nk, n.c_name nname,
            n.c_mktsegment nseg, (o.c_name = n.c_name and o.c_mktsegment = n.c_mktsegment) same
          from customer o full join nxt n on o.c_custkey = n.c_custkey and o.c_nationkey = n.c_nationkey)
        select ok c_custkey, onat c_nationkey, oname c_name, oseg c_mktsegment, '2024-01-01' since,
          case when coalesce(same, false) then 'open' else '2024-06-01' end until,
          coalesce(same, false) is_current from j where ok is not null
        union all select nk, nnat, nname, nseg, '2024-06-01', 'open', true from j
          where nk is not null and not coalesce(same, false)""",
)
def scd2_merge(spark, sf_dir):
    """A first load and a changed snapshot, by a key of two columns; the same snapshot again changes nothing."""
    customer = _read(spark, sf_dir, "customer")
    path = scratch(spark, "customer-history")
    first = customer.select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    start_history(first, path, date(2024, 1, 1))
    snapshot = customer.filter("c_acctbal <= 9500").selectExpr(
        "c_custkey + if(c_nationkey = 0, 100000000, 0) as c_custkey",
        "c_nationkey",
        "c_name",
        "if(c_acctbal < 0, 'AT RISK', c_mktsegment) as c_mktsegment",
    )
    for day in (date(2024, 6, 1), date(2024, 7, 1)):
        merge_history(snapshot, path, ["c_custkey", "c_nationkey"], day)
    return read_history(spark, path, first.schema).selectExpr(
        "c_custkey", "c_nationkey", "c_name", "c_mktsegment", "cast(valid_from as string) as since",
        "coalesce(cast(valid_to as string), 'open') as until", "is_current",
    )


# ---- star schema -------------------------------------------------------------------------------

_REV = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"


@query(
    "star_join_agg",
    f"""select n_name, p_type, year(l_shipdate)::integer ship_year, count(*) n_lines,
          cast(sum(cast(l_quantity as decimal(12,2))) as decimal(18,2)) quantity,
          cast(sum({_REV}) as decimal(22,4)) revenue
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
        join nation on s_nationkey = n_nationkey group by all""",
)
def star_join_agg(spark, sf_dir):
    names = ("lineitem", "part", "supplier", "nation")
    return star.star_join_agg(*[_read(spark, sf_dir, n) for n in names])


@query(
    "preagg_month_brand",
    f"""select strftime(l_shipdate, '%Y-%m') as month, p_brand,
          grouping(strftime(l_shipdate, '%Y-%m'), p_brand)::integer as level, count(*) n_lines,
          cast(sum(cast(l_quantity as decimal(12,2))) as decimal(18,2)) quantity,
          cast(sum({_REV}) as decimal(22,4)) revenue
        from lineitem join part on l_partkey = p_partkey
        group by cube (strftime(l_shipdate, '%Y-%m'), p_brand)""",
)
def preagg_month_brand(spark, sf_dir):
    return star.month_brand_cube(_read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "part"))


_HOLIDAY_SQL = " ".join(
    f"when month(d) = {m} and day(d) = {day} then '{name}'" for m, day, name in holidays()
)


@query(
    "calendar_dim",
    f"""with span as (select min(o_orderdate)::date a, max(o_orderdate)::date b from orders),
        days as (select unnest(generate_series(a::timestamp, b::timestamp, interval 1 day))::date d
                 from span),
        per_day as (select o_orderdate::date od, count(*) n from orders group by all)
        select strftime(d, '%Y%m%d') date_key, year(d)::integer as year,
          quarter(d)::integer as quarter, month(d)::integer as month, week(d)::integer iso_week,
          isodow(d)::integer iso_weekday, isodow(d) >= 6 is_weekend, case {_HOLIDAY_SQL} end holiday,
          coalesce(n, 0) n_orders
        from days left join per_day on od = d""",
)
def calendar_days(spark, sf_dir):
    """The calendar from the first to the last order day with the orders of each day."""
    orders = _read(spark, sf_dir, "orders").selectExpr("cast(o_orderdate as date) as od")
    span = orders.agg(F.min("od").alias("first_day"), F.max("od").alias("last_day"))
    per_day = orders.groupBy("od").agg(F.count("*").alias("n"))
    out = calendar_dim(span).join(per_day, F.col("day") == F.col("od"), "left")
    return out.selectExpr(
        "date_key", "year", "quarter", "month", "iso_week", "iso_weekday", "is_weekend", "holiday",
        "coalesce(n, 0) as n_orders",
    )


# ---- demand ------------------------------------------------------------------------------------

_QTY = "cast(l_quantity as decimal(12,2))"


@query(
    "seasonal_weighted_sales",
    f"""with {S.PARTS}, vectors as (select k, department,
          {S.season_vector("season", S.wobble(7, "k"))} vec from parts)
        select department, month(l_shipdate)::integer as month,
          cast(sum({_QTY}) as decimal(18,2)) quantity,
          cast(sum({_QTY} * cast(vec[month(l_shipdate)] as decimal(4,2))) as decimal(20,4))
            weighted_quantity
        from lineitem join vectors on l_partkey = k group by all""",
)
def seasonal_weighted_sales(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return DM.seasonal_weighted_sales(lines, read_part_products(spark, sf_dir))


@query(
    "expected_wastage",
    f"""with {S.PARTS}, vectors as (select *, {S.season_vector("season", S.wobble(7, "k"))} vec from parts)
        select department, category, cast(sum({_QTY}) as decimal(18,2)) quantity,
          cast(sum({_QTY} * coalesce(cast(wastage_rate_baseline as decimal(4,2)), 0)
            * coalesce(cast(vec[month(l_shipdate)] as decimal(4,2)), 1)) as decimal(22,6)) expected_wastage
        from lineitem join vectors on l_partkey = k group by all""",
)
def expected_wastage(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    return DM.expected_wastage(lines, read_part_products(spark, sf_dir))


_WEEKLY = f"""weekly as (select l_partkey, case when l_shipdate::date between date '{DM.FIRST_DAY}' and date '{DM.LAST_DAY}'
            then (floor(date_diff('day', date '1970-01-05', l_shipdate::date) / 7))::integer end as week,
            sum({_QTY}) qty from lineitem group by all)"""


@query(
    "forecast_seasonal_naive",
    f"""with {_WEEKLY},
        span as (select l_partkey, min(week) a, max(week) z from weekly where week is not null group by all),
        grid as (select l_partkey, z, unnest(range(a, z + 5))::integer as week from span),
        full_weeks as (select l_partkey, week, z, case when week <= z then coalesce(qty, 0) end qty
          from grid left join weekly using (l_partkey, week))
        select l_partkey, week, cast(qty as decimal(18,2)) demand,
          cast(sum(qty) over (partition by l_partkey order by week
            range between 52 preceding and 52 preceding) as decimal(18,2)) naive_forecast,
          cast(case when week > z
            then coalesce(sum(case when week > z - 4 then qty end) over (partition by l_partkey), 0)
            else coalesce(sum(qty) over (partition by l_partkey order by week
              range between 4 preceding and 1 preceding), 0) end * 0.25 as decimal(18,4)) mean_4_weeks
        from full_weeks
        union all select l_partkey, null, cast(qty as decimal(18,2)), null, null from weekly where week is null""",
)
def forecast_seasonal_naive(spark, sf_dir):
    return DM.seasonal_naive_forecast(DM.weekly_demand(_read(spark, sf_dir, "lineitem")))


_GRID = ", ".join(f"({i}, {a}::double, {b}::double, {c}::double)" for i, (a, b, c) in enumerate(SM.GRID))


@query(
    "forecast_fitted",
    f"""with recursive {_WEEKLY},
        span as (select l_partkey, min(week) a, max(week) z from weekly where week is not null group by all),
        grid as (select l_partkey, unnest(range(a, z + 1))::integer as week from span),
        dense as (select l_partkey, min(week) a, count(*)::integer n,
            list(coalesce((qty * 100)::bigint, 0) order by week) c
          from grid left join weekly using (l_partkey, week) group by all),
        base as (select *, n - least(26, n // 4)::integer train, list_transform(c, lambda x: x / 100::double) y from dense),
        params(i, alpha, beta, gamma) as (values {_GRID}),
        run(l_partkey, i, t, l, b, s, fit, ae, se) using key (l_partkey, i) as (
          select l_partkey, i, 0, list_sum(c[1:least(52, train)])::bigint / 100::double / least(52, train), 0::double,
            list_transform(range(13), lambda x: 0::double), 0::double, 0::double, 0::double from base cross join params
          union
          select l_partkey, i, t + 1, l + b + alpha * (yt - f), b + beta * (yt - f),
            case when gamma = 0 then s else list_transform(s, lambda x, j: case when j = p + 1 then x + gamma * (yt - f) else x end) end,
            fit + case when t < train then (yt - f) * (yt - f) else 0 end,
            ae + case when t < train then 0 else abs(yt - greatest(f, 0)) end,
            se + case when t < train then 0 else (yt - greatest(f, 0)) * (yt - greatest(f, 0)) end
          from (select r.*, alpha, beta, gamma, train, y[t + 1] yt, ((a + t) % 52) // 4 p, l + b + s[((a + t) % 52) // 4 + 1] f
            from run r join base using (l_partkey) join params using (i) where t < n)),
        best as (select * from run qualify row_number() over (partition by l_partkey order by fit, i) = 1),
        naive as (select l_partkey, list_transform(range(train, n), lambda t: y[t + 1] - case when t >= 52 then y[t - 51] else y[t] end) d from base)
        select l_partkey, (a + n + h - 1)::integer as week, greatest(l + h * b + s[((a + n + h - 1) % 52) // 4 + 1], 0) forecast,
          n n_weeks, n - train n_tested, alpha, beta, gamma,
          ae / nullif(n - train, 0) mae, sqrt(se / nullif(n - train, 0)) rmse,
          list_reduce(list_transform(d, lambda x: abs(x)), lambda u, v: u + v, 0::double) / nullif(n - train, 0) naive_mae,
          sqrt(list_reduce(list_transform(d, lambda x: x * x), lambda u, v: u + v, 0::double) / nullif(n - train, 0)) naive_rmse
        from best join base using (l_partkey) join params using (i) join naive using (l_partkey), unnest(range(1, 5)) u(h)""",
)
def forecast_fitted(spark, sf_dir):
    return SM.fitted_forecast(DM.weekly_arrays(DM.weekly_demand(_read(spark, sf_dir, "lineitem"))))
