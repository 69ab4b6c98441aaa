"""Jobs, partitioned loads, streaming and history."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from larder.operators import demand as DM
from larder.operators import history as H
from larder.operators import quality as Q
from larder.operators.calendar import calendar_dim
from larder.plans.jobs import JobSettings, job_backfill, job_daily, job_products
from larder.session import scratch, shared_folder
from larder.sources.partitioned import read_partitions, write_partitions
from larder.sources.history import merge_history, read_history, start_history
from larder.streaming.incremental import load_new_files


def test_settings():
    s = JobSettings.from_env({"LARDER_SEED": "7", "LARDER_START_DATE": "2024-02-01", "X": "1"})
    assert (s.seed, s.start_date, s.n_products) == (7, date(2024, 2, 1), 2000)
    with pytest.raises(ValueError):
        JobSettings.from_env({"LARDER_END_DATE": "2020-01-01"})
    with pytest.raises(ValueError):
        JobSettings(country="NZ")


def test_products_job(spark, tmp_path):
    path = job_products(spark, 100, 42, str(tmp_path / "new" / "folder"))
    df = spark.read.parquet(path)
    assert path.endswith("dim_product.parquet")
    assert df.count() == df.select("product_id").distinct().count() == 100
    assert dict(df.dtypes)["seasonality_vector"] == "array<double>"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch(spark, "x"), scratch(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))


def test_command_line(spark, sf_dir, tmp_path, capsys):
    from larder.__main__ import main

    main(["products", "--count", "60", "--out", str(tmp_path)])
    assert spark.read.parquet(str(tmp_path / "dim_product.parquet")).count() == 60
    events, out = f"{sf_dir}/events.parquet", str(tmp_path / "events")
    main(["backfill", "--source", events, "--end", "2024-01-10", "--out", out])
    main(["daily", "--source", events, "--date", "2024-01-12", "--out", out])
    loaded = days(spark.read.parquet(out))
    assert max(loaded) == "2024-01-12" and "2024-01-11" not in loaded
    assert capsys.readouterr().out.splitlines()[-1] == out


def days(df):
    rows = df.groupBy(F.col("event_date").cast("string").alias("d")).count().collect()
    return {r.d: r["count"] for r in rows}


def test_backfill_replaces_only_its_days(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    want = {
        r.d: r["count"]
        for r in events.groupBy(F.col("ts").cast("date").cast("string").alias("d")).count().collect()
    }
    out = str(tmp_path / "events")
    job_backfill(events, date(2024, 1, 1), date(2024, 1, 12), out)
    job_backfill(events, date(2024, 1, 10), date(2024, 1, 20), out)
    before = days(spark.read.parquet(out))
    assert before == {d: n for d, n in want.items() if d <= "2024-01-20"}
    # Part of one day is loaded again: that day is replaced, no other changes.
    clicks = events.filter("event_type = 'click'")
    job_daily(clicks, date(2024, 1, 5), out)
    n = clicks.filter("cast(ts as date) = date'2024-01-05'").count()
    assert days(spark.read.parquet(out)) == {**before, "2024-01-05": n}
    job_daily(events, date(2024, 1, 25), out)
    assert set(days(spark.read.parquet(out))) - set(before) == {"2024-01-25"}


def test_backfill_filter_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.col("ts")
    wanted = events.filter(
        (ts >= F.lit(date(2024, 1, 5)).cast("date")) & (ts < F.date_add(F.lit(date(2024, 1, 6)), 1))
    )
    text = wanted._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


def test_stream_loads_each_file_once(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / p) for p in ("in", "out", "ckpt"))
    rows = spark.range(1000).selectExpr(
        "id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 5 as int)) as ts"
    )
    rows.filter("id < 400").write.mode("append").parquet(src)
    load_new_files(spark, src, rows.schema, out, ckpt, files_per_batch=2)
    assert spark.read.parquet(out).count() == 400
    load_new_files(spark, src, rows.schema, out, ckpt)
    assert spark.read.parquet(out).count() == 400
    rows.filter("id >= 400").write.mode("append").parquet(src)
    load_new_files(spark, src, rows.schema, out, ckpt)
    got = spark.read.parquet(out)
    assert got.select("id").distinct().count() == got.count() == 1000
    assert got.select("event_date").distinct().count() == 5


def test_dedup_latest_against_brute_force(spark):
    rnd = random.Random(3)
    # One key holds a third of the rows.
    rows = [
        (7 if i % 3 == 0 else rnd.randrange(200), rnd.randrange(5), rnd.choice("abc"), rnd.random())
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "k int, v int, s string, x double").repartition(16)
    best = {}
    for r in rows:
        if r[0] not in best or (r[1], r[2], r[3]) > best[r[0]][1:]:
            best[r[0]] = r
    got = H.dedup_latest(df, ["k"], ["v"])
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(best.values())
    assert H.dedup_exact(df.union(df)).count() == len(set(rows))


def test_surrogate_keys(spark):
    dim = spark.range(5000).selectExpr("id as c", "'n' || id as name")
    keyed = H.with_surrogate_key(dim, ["c"], "sk")
    assert Q.duplicate_keys(keyed, ["sk"]).count() == 0
    facts = spark.range(6000).selectExpr("id as fc", "1 as one")
    swapped = H.swap_keys(facts, keyed, {"fc": "c"}, "sk")
    assert swapped.columns == ["sk", "one"]
    assert swapped.filter(F.col("sk") == H.UNKNOWN_KEY).count() == 1000
    assert swapped.join(keyed, "sk").count() == 5000


def test_scd2_history(spark):
    first = spark.sql("select * from values (1, 'a'), (2, 'b'), (3, null), (4, 'd') as t(k, x)")
    second = spark.sql("select * from values (1, 'a'), (2, 'B'), (3, null), (5, 'e') as t(k, x)")
    third = spark.sql("select * from values (1, 'a'), (2, 'b'), (3, 'c'), (5, 'e') as t(k, x)")
    dim = H.open_history(first, date(2024, 1, 1))
    dim = H.scd2_merge(dim, second, "k", date(2024, 2, 1))
    dim = H.scd2_merge(dim, third, "k", date(2024, 3, 1))
    got = sorted(
        (r.k, r.x, r.valid_from.month, r.valid_to and r.valid_to.month, r.is_current)
        for r in dim.filter("k <> 3").collect()
    )
    assert got == [
        (1, "a", 1, None, True),
        (2, "B", 2, 3, False),
        (2, "b", 1, 2, False),
        (2, "b", 3, None, True),
        (4, "d", 1, 2, False),
        (5, "e", 2, None, True),
    ]
    three = [(r.x, r.is_current) for r in dim.filter("k = 3").orderBy("valid_from").collect()]
    assert three == [(None, False), ("c", True)]
    # Nothing changes when the same snapshot comes again.
    again = H.scd2_merge(dim, third, "k", date(2024, 4, 1))
    assert again.exceptAll(dim).count() == dim.exceptAll(again).count() == 0


def test_history_on_disk(spark, tmp_path):
    path = str(tmp_path / "history")

    def snapshot(text):
        return spark.sql(f"select * from values {text} as t(k, x)")

    start_history(snapshot("(1, 'a'), (2, 'b')"), path, date(2024, 1, 1))
    merge_history(snapshot("(1, 'a'), (2, 'B'), (3, 'c')"), path, "k", date(2024, 2, 1))
    old = sorted(p.name for p in (tmp_path / "history" / "valid_to=2024-02-01").iterdir())
    for _ in range(2):
        merge_history(snapshot("(1, 'A'), (2, 'B')"), path, "k", date(2024, 3, 1))
    # The partition of the earlier merge was left alone.
    assert old == sorted(p.name for p in (tmp_path / "history" / "valid_to=2024-02-01").iterdir())
    rows = read_history(spark, path, snapshot("(1, 'a')").schema).collect()
    got = sorted((r.k, r.x, r.valid_from.month, r.valid_to and r.valid_to.month) for r in rows)
    assert got == [
        (1, "A", 3, None), (1, "a", 1, 3), (2, "B", 2, None), (2, "b", 1, 2), (3, "c", 2, 3),
    ]
    assert all(r.is_current == (r.valid_to is None) for r in rows)
    merged = read_history(spark, path, snapshot("(1, 'a')").schema).filter("valid_to is null")
    assert "PartitionFilters: [isnull(valid_to" in (
        merged._jdf.queryExecution().executedPlan().toString()
    )
    # A second, different snapshot of the same day keeps what the first one closed.
    merge_history(snapshot("(2, 'B'), (4, 'd')"), path, "k", date(2024, 3, 1))
    rows = read_history(spark, path, snapshot("(1, 'a')").schema).collect()
    march = sorted((r.k, r.x) for r in rows if r.valid_to == date(2024, 3, 1))
    assert march == [(1, "A"), (1, "a"), (3, "c")]
    assert sorted((r.k, r.x) for r in rows if r.is_current) == [(2, "B"), (4, "d")]
    with pytest.raises(ValueError, match="empty"):
        merge_history(snapshot("(1, 'a')").filter("false"), path, "k", date(2024, 4, 1))
    assert read_history(spark, path, snapshot("(1, 'a')").schema).count() == len(rows)


def test_calendar(spark):
    span = spark.sql("select date'2023-12-24' as first_day, date'2024-03-01' as last_day")
    rows = {r.date_key: r for r in calendar_dim(span).collect()}
    assert len(rows) == 69 and "20240229" in rows
    assert rows["20231225"].holiday == "Christmas Day" and rows["20240101"].iso_week == 1
    assert rows["20240106"].is_weekend and rows["20240107"].iso_weekday == 7
    assert not rows["20240108"].is_weekend


def test_forecast(spark):
    rows = [(1, 0, 5), (1, 50, 2), (1, 52, 7), (1, 53, 1), (2, 52, 9)]
    weekly = spark.createDataFrame(rows, "l_partkey long, week int, q int")
    weekly = weekly.selectExpr("l_partkey", "week", "cast(q as decimal(12,2)) as qty")
    got = {(r[0], r[1]): r for r in DM.seasonal_naive_forecast(weekly, horizon=3).collect()}
    # Every week from the first sale to three weeks past the last one.
    assert sorted(got) == [(1, w) for w in range(57)] + [(2, w) for w in range(52, 56)]
    assert float(got[1, 52].naive_forecast) == 5 and float(got[1, 52].mean_4_weeks) == 0.5
    assert float(got[1, 53].naive_forecast) == 0 and float(got[1, 53].mean_4_weeks) == 2.25
    assert float(got[1, 10].demand) == 0 and got[1, 10].naive_forecast is None
    for week in (54, 55, 56):
        assert got[1, week].demand is None and float(got[1, week].mean_4_weeks) == 2.5
    assert got[2, 52].naive_forecast is None and float(got[2, 52].mean_4_weeks) == 0
    assert float(got[2, 55].mean_4_weeks) == 2.25


def test_partition_keys_keep_their_values(spark, tmp_path):
    rows = [(i, d) for i, d in enumerate(["007", "7", "1e1", "10", "2024-01-01", None])]
    df = spark.createDataFrame(rows, "id int, domain string")
    path = write_partitions(df, str(tmp_path / "p"), ["domain"])
    got = read_partitions(spark, path, df.schema)
    assert sorted((r.id, r.domain) for r in got.collect()) == sorted(rows)
    text = got.filter("domain = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(domain" in text


def test_rows_without_a_time_are_kept(spark, tmp_path):
    events = spark.sql(
        "select id, if(id % 4 = 0, null, timestamp_ntz'2024-01-01 10:00:00') as ts from range(20)"
    )
    out = str(tmp_path / "events")
    for _ in range(2):
        job_daily(events, date(2024, 1, 1), out)
    assert days(spark.read.parquet(out)) == {"2024-01-01": 15, None: 5}


def test_a_load_refuses_the_folder_of_a_stream(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / p) for p in ("in", "out", "ckpt"))
    rows = spark.range(9).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' as ts")
    rows.write.parquet(src)
    load_new_files(spark, src, rows.schema, out, ckpt)
    with pytest.raises(ValueError, match="stream"):
        job_daily(rows, date(2024, 1, 1), out)
    assert spark.read.parquet(out).count() == 9


def test_history_of_awkward_snapshots(spark, tmp_path):
    path = str(tmp_path / "history")

    def snapshot(text):
        return spark.sql(f"select * from values {text} as t(k, j, x)")

    first = snapshot("(1, 'a', 'p'), (null, 'a', 'q'), (1, 'b', 'r')")
    start_history(first, path, date(2024, 1, 1))
    merge_history(snapshot("(1, 'a', 'p'), (null, 'a', 'Q'), (2, 'b', 's')"), path, ["k", "j"], date(2024, 2, 1))
    got = read_history(spark, path, first.schema).collect()
    assert sorted((str(r.k), r.j, r.x, r.is_current) for r in got) == [
        ("1", "a", "p", True), ("1", "b", "r", False), ("2", "b", "s", True),
        ("None", "a", "Q", True), ("None", "a", "q", False),
    ]
    with pytest.raises(ValueError, match="repeats keys"):
        merge_history(snapshot("(1, 'a', 'p'), (1, 'a', 'z')"), path, ["k", "j"], date(2024, 3, 1))
    with pytest.raises(ValueError, match="before the last merge"):
        merge_history(snapshot("(1, 'a', 'p')"), path, ["k", "j"], date(2024, 1, 15))
    assert read_history(spark, path, first.schema).count() == len(got)


def test_surrogate_keys_must_be_unique(spark):
    dim = spark.sql("select * from values (1, 'a'), (1, 'b') as t(c, name)")
    with pytest.raises(ValueError, match="more than once"):
        H.with_surrogate_key(dim, ["c"], "sk")
