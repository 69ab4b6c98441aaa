"""The stream into days, with late and repeated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import query
from larder.session import scratch
from larder.streaming.dated import DatedSink

# Three batches by time. Some events come again with the next batch, some of the first days only with the last one.
_BATCH = "case when ts < timestamp_ntz'2024-01-11' then 0 when ts < timestamp_ntz'2024-01-21' then 1 else 2 end"
_SQL_BATCH = _BATCH.replace("timestamp_ntz", "timestamp ")


@query(
    "stream_late_rows",
    f"""with e as (select *, {_SQL_BATCH} third from events),
        a as (select event_id, ts, case when third = 0 and event_id % 10 = 3 then 2 else third end b from e
          union all select event_id, ts, third + 1 from e where event_id % 7 = 0 and third < 2 and not (third = 0 and event_id % 10 = 3)),
        marks as (select n.b, max(a.ts) - interval 1 day mark from (values (1), (2)) n(b) join a on a.b < n.b group by n.b),
        r as (select a.*, mark is null or ts >= mark on_time from a left join marks using (b))
        select strftime(ts, '%Y-%m-%d') as day_key, count(distinct event_id) filter (on_time) n_on_time,
          count(*) filter (not on_time) n_late from r group by 1""",
)
def stream_late_rows(spark, sf_dir):
    """Rows on time and late by day, after three batches of which one is committed twice."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("third", F.expr(_BATCH))
    late = F.expr("third = 0 and event_id % 10 = 3")
    first = events.withColumn("b", F.when(late, 2).otherwise(F.col("third")))
    again = events.where(F.expr("event_id % 7 = 0 and third < 2") & ~late).withColumn("b", F.col("third") + 1)
    arrived = first.unionByName(again).drop("third")
    sink = DatedSink(spark, scratch(spark, "stream-days"), events.drop("third").schema, ["event_id"])
    for number in (0, 1, 1, 2):
        sink.write_batch(arrived.where(F.col("b") == number).drop("b"), number)
    day = F.date_format("ts", "yyyy-MM-dd").alias("day_key")
    both = sink.rows().select(day, F.lit(1).alias("n"), F.lit(0).alias("m")).unionByName(sink.late().select(day, F.lit(0).alias("n"), F.lit(1).alias("m")))
    return both.groupBy("day_key").agg(F.sum("n").cast("bigint").alias("n_on_time"), F.sum("m").cast("bigint").alias("n_late"))
