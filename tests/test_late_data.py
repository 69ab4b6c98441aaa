"""Loads, histories and streams under late, repeated and missing data."""

import itertools
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larder.operators import changes as CH
from larder.operators.allocate import allocate
from larder.plans.jobs import dated, job_daily
from larder.sources import history as SH
from larder.sources.partitioned import read_partitions
from larder.streaming.dated import DatedSink, load_stream


def test_two_daily_sources_keep_their_rows_without_a_time(spark, tmp_path):
    def source(first, n):
        return spark.range(first, first + n).selectExpr("id", "if(id % 4 = 0, null, timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id div 100 as int))) as ts")

    out = str(tmp_path / "events")
    job_daily(source(0, 20), date(2024, 1, 1), out, source="mon.parquet")
    job_daily(source(100, 20), date(2024, 1, 2), out, source="tue.parquet")
    job_daily(source(0, 16), date(2024, 1, 1), out, source="mon.parquet")
    rows = read_partitions(spark, out, dated(source(0, 1)).schema)
    want = {*range(16), *range(100, 120)}
    assert {r.id for r in rows.collect()} == want and rows.count() == len(want)
    assert rows.where("ts is null").count() == 4 + 5
    with pytest.raises(ValueError, match="named"):
        job_daily(source(0, 1), date(2024, 1, 1), out, source="-")


def facts(df):
    return sorted((r.k, r.x, str(r.valid_from), str(r.valid_to)) for r in df.collect())


def test_a_merge_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    def snapshot(text):
        return spark.sql(f"select * from values {text} as t(k, x)")

    days = [("(1, 'a'), (2, 'B'), (4, 'd')", date(2024, 2, 1)), ("(2, 'C'), (4, 'd')", date(2024, 2, 2))]
    plain, hurt = str(tmp_path / "plain"), str(tmp_path / "hurt")
    for path in (plain, hurt):
        SH.start_history(snapshot("(1, 'a'), (2, 'b'), (3, 'c')"), path, date(2024, 1, 1))
    for text, day in days:
        SH.merge_history(snapshot(text), plain, "k", day)
    write, calls = SH._write, []

    def dies(df, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write(df, path)

    monkeypatch.setattr(SH, "_write", dies)
    with pytest.raises(RuntimeError):
        SH.merge_history(snapshot(days[0][0]), hurt, "k", days[0][1])
    monkeypatch.setattr(SH, "_write", write)
    SH.merge_history(snapshot(days[1][0]), hurt, "k", days[1][1])
    schema = snapshot("(1, 'a')").schema
    assert facts(SH.read_history(spark, hurt, schema)) == facts(SH.read_history(spark, plain, schema))
    # A journal that was cut short is dropped, and the merge is done again.
    os.makedirs(f"{hurt}_journal")
    SH.merge_history(snapshot(days[1][0]), hurt, "k", date(2024, 2, 3))
    assert facts(SH.read_history(spark, hurt, schema)) == facts(SH.read_history(spark, plain, schema))
    assert not os.path.exists(f"{hurt}_journal")


def test_missing_ties_and_weights(spark):
    df = spark.createDataFrame([(None, 1), ("a", 1), ("b", None), ("c", 1)], "tie string, weight bigint")
    assert {r.tie: r.n for r in allocate(df, 4, tie="tie").collect()} == {None: 2, "a": 1, "b": 0, "c": 1}
    df = spark.createDataFrame([(None, 1), (5, 1), (7, None)], "alloc_no int, weight bigint")
    assert {r.alloc_no: r.n for r in allocate(df, 3).collect()} == {None: 2, 5: 1, 7: 0}
    assert allocate(df.where("false"), 3).collect() == []
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|REMAINDER_BY_ZERO"):
        allocate(df.where("weight is null"), 3).collect()


def test_text_ties_with_a_common_start_spread(spark):
    n = 100_000
    df = spark.range(n).selectExpr("concat('a common start ', lpad(id, 6, '0')) as tie", "7L as weight")
    got = allocate(df, 2 * n + 10, tie="tie")
    assert sorted(r.tie for r in got.filter("n = 3").collect()) == [f"a common start {i:06d}" for i in range(10)]
    from larder.operators.allocate import _slot

    assert df.select(_slot(df, "tie").alias("s")).distinct().count() > 1000


# Changes out of order -------------------------------------------------------------------------------


def brute_history(changes):
    out, by_key = [], {}
    for k, x, at, arrival, gone in changes:
        if at is not None:
            by_key.setdefault(k, {}).setdefault(at, []).append((arrival, gone, x is not None, x or ""))
    for k, times in by_key.items():
        now, since = None, None
        for at in sorted(times):
            _, gone, there, x = max(times[at])
            state = None if gone else (x if there else None,)
            if state != now:
                if now is not None:
                    out.append((k, now[0], since, at))
                now, since = state, at
        if now is not None:
            out.append((k, now[0], since, None))
    return sorted(out, key=str)


def test_any_order_of_arrival_gives_one_history(spark):
    rng = random.Random(2)
    base = []
    for k in [*range(12), None]:
        for _ in range(rng.randrange(1, 9)):
            base.append((k, rng.choice(["a", "b", None]), rng.randrange(0, 9), rng.random() < 0.3))
    base.append((3, "a", None, False))
    schema = "k int, x string, event_time int, arrival int, is_deleted boolean"
    for trial in range(3):
        rng.shuffle(base)
        unique = {(k, at): (k, x, at, gone) for k, x, at, gone in sorted(base, key=str)}  # one change per key and time: order can't matter
        rows = [(k, x, at, rng.randrange(1, 4), gone) for k, x, at, gone in unique.values()]
        feed = spark.createDataFrame(rows, schema)
        known = CH.empty_history(feed, ["k"], ["x"])
        for batch in (1, 2, 2, 3):  # the second batch twice
            known = CH.merge_arrivals(known, feed, ["k"], ["x"], batch)
            known = spark.createDataFrame(known.collect(), known.schema)
        for batch in (1, 2, 3):
            got = sorted((tuple(r) for r in CH.known_at(known, batch).collect()), key=str)
            assert got == brute_history([r for r in rows if r[3] <= batch])
        final = sorted((tuple(r) for r in CH.valid_history(feed, ["k"], ["x"]).collect()), key=str)
        assert final == brute_history(rows)
        if trial:
            assert final == before
        before = final
    assert CH.undated_changes(feed).count() == 1


def test_ties_deletes_and_returns(spark):
    rows = [(1, "a", 1, 1, False), (1, "b", 1, 2, False), (1, "b", 3, 1, True), (1, "b", 5, 3, False), (1, "b", 6, 3, False), (2, "x", 1, 1, True)]
    feed = spark.createDataFrame(rows, "k int, x string, event_time int, arrival int, is_deleted boolean")
    got = sorted(tuple(r) for r in CH.valid_history(feed, ["k"], ["x"]).collect())
    assert got == [(1, "b", 1, 3), (1, "b", 5, None)]
    assert CH.valid_history(feed.where("false"), ["k"], ["x"]).collect() == []


# Stream with late and repeated rows -------------------------------------------------------------------

START = datetime(2024, 3, 1)


def batches():
    """Rows by batch: repeats inside and across batches, late ones, some without a time."""
    def row(i, hours):
        return (i, None if hours is None else START + timedelta(hours=hours), float(i))

    return [
        [row(1, 1), row(2, 5), row(2, 5), row(3, 20)],
        [row(3, 20), row(4, 30), row(5, 3), row(6, None)],
        [row(7, 60), row(8, 40)],
        [row(9, 2), row(7, 60), row(10, 37), row(1, 1)],  # 9 and 1 are late: the watermark stands at hour 36
    ]


SCHEMA = "id bigint, ts timestamp_ntz, v double"


def frames(spark):
    return [spark.createDataFrame(b, SCHEMA) for b in batches()]


def sink_at(spark, path):
    return DatedSink(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["id"])


def test_late_and_repeated_rows(spark, tmp_path):
    sink = sink_at(spark, tmp_path / "s")
    order = [0, 1, 1, 2, 0, 3, 3]  # batches that were run again, also an old one
    for i in order:
        sink.write_batch(frames(spark)[i], i)
    assert sorted(r.id for r in sink.rows().collect()) == [1, 2, 3, 4, 5, 7, 8, 10]
    assert sorted((r.id, r.batch) for r in sink.late().collect()) == [(1, 3), (6, 1), (9, 3)]
    assert sink.watermark() == START + timedelta(hours=36)
    assert sink._days("done") == {START.date()}


def test_files_of_a_day_are_bounded(spark, tmp_path):
    src, out = str(tmp_path / "in"), tmp_path / "out"
    for i in range(20):
        rows = [(100 * i + j, START + timedelta(hours=j % 20), 1.0) for j in range(30)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    sink = sink_at(spark, out)
    schema = spark.createDataFrame([], SCHEMA).schema

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src)

    load_stream(stream(), sink, str(tmp_path / "ckpt"))
    assert sink.rows().count() == 600 and sink.watermark() == START + timedelta(hours=19 - 24)
    last = [(9999, START + timedelta(days=3), 1.0)]
    spark.createDataFrame(last, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    load_stream(stream(), sink, str(tmp_path / "ckpt"))
    day = out / "done" / f"event_date={START.date()}"
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) <= 2
    assert sink.rows().count() == 601 and sink.rows().select("id").distinct().count() == 601
    load_stream(stream(), sink, str(tmp_path / "ckpt"))
    assert sink.rows().count() == 601
    for order in itertools.islice(itertools.permutations(range(3)), 2):
        other = sink_at(spark, tmp_path / f"o{order[0]}{order[1]}")
        assert other.rows().collect() == [] and other.late().collect() == [] and other.watermark() is None
