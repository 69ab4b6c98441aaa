"""Layer tables, gates and the layer run."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from larder.lookups import Lookups
from larder.operators import layers as L
from larder.operators import model as M
from larder.operators import quality as Q
from larder.plans.builder import build_products
from larder.plans.layer_run import LayerConfig, run_gold, run_layers, run_silver
from larder.sources.landing import read_landing, write_rows
from larder.sources.tables import ensure_schema, read_layer, write_layer

AT = datetime(2024, 3, 1, 4, 5, 6, tzinfo=UTC)


def config(tmp_path, tag, **over):
    names = {layer: f"{layer}_{tag}" for layer in ("bronze", "silver", "gold")}
    args = {"landing": str(tmp_path / "landing.parquet"), "location": str(tmp_path), "at": AT}
    return LayerConfig(**{**args, **names, **over})


def test_run_end_to_end(spark, tmp_path):
    cfg = config(tmp_path, "e2e", full_rules=True)
    write_rows(build_products(spark, 2000), cfg.landing)
    report = run_layers(spark, cfg)
    assert (report.batch, report.n_rows) == ("20240301T040506Z", 2000)
    gold = read_layer(spark, cfg.gold, cfg.table)
    stats = L.layer_stats(gold).first()
    assert (report.n_perishable, report.n_seasonal) == (stats.n_perishable, stats.n_seasonal)
    assert len(gold.columns) == 22
    bronze = read_layer(spark, cfg.bronze, cfg.table)
    assert bronze.columns[-3:] == list(L.LINEAGE)
    assert bronze.select("_ingestion_batch_id", "_source_file").distinct().collect() == [
        (report.batch, cfg.landing)
    ]
    assert all(r.passed for r in Q.check_suite(gold, Q.gold_suite()).collect())
    assert len(M.model_projection(gold).columns) == 20
    view = M.create_model_view(spark, f"{cfg.gold}.{cfg.table}", f"{cfg.gold}.model")
    assert view.count() == 2000
    assert spark.newSession().table(f"{cfg.gold}.model").count() == 2000
    # A second run replaces the content.
    assert run_layers(spark, cfg).n_rows == 2000


def test_failed_gate_leaves_silver_unchanged(spark, tmp_path):
    cfg = config(tmp_path, "gate", expected_rows=None)
    write_rows(build_products(spark, 60), cfg.landing)
    run_layers(spark, cfg)
    before = read_layer(spark, cfg.silver, cfg.table).collect()
    bad = read_layer(spark, cfg.bronze, cfg.table)
    write_layer(bad.unionByName(bad.limit(1)), f"{cfg.bronze}.{cfg.table}")
    with pytest.raises(Q.GateFailed, match="duplicate_keys: 1 of 61"):
        run_silver(spark, cfg)
    assert read_layer(spark, cfg.silver, cfg.table).collect() == before


def test_expected_rows_gate(spark, tmp_path):
    cfg = config(tmp_path, "count", expected_rows=2000)
    write_rows(build_products(spark, 50), cfg.landing)
    with pytest.raises(Q.GateFailed, match="expected_count"):
        run_layers(spark, cfg)
    assert not spark.catalog.tableExists(f"{cfg.silver}.{cfg.table}")


def test_merge_keeps_and_fills_columns(spark, schema):
    table = f"{schema}.t"
    write_layer(spark.sql("select 1 as id, 'x' as a"), table, evolve="merge")
    write_layer(spark.sql("select 2 as id, 'x' as a, 3.5D as b"), table, evolve="merge")
    assert spark.table(table).columns == ["id", "a", "b"]
    write_layer(spark.sql("select 3 as id, 1.5D as b"), table, evolve="merge")
    assert spark.table(table).collect() == [(3, None, 1.5)]
    with pytest.raises(TypeError, match="column b was double"):
        write_layer(spark.sql("select 4 as id, 'text' as b"), table, evolve="merge")
    assert spark.table(table).collect() == [(3, None, 1.5)]


def test_replace_takes_the_new_schema_and_may_read_itself(spark, schema):
    table = f"{schema}.t"
    write_layer(spark.range(10).selectExpr("id", "'x' as a"), table)
    write_layer(spark.table(table).filter("id < 4").drop("a"), table)
    assert spark.table(table).columns == ["id"]
    assert spark.table(table).count() == 4


def test_failing_write_keeps_the_old_table(spark, schema):
    table = f"{schema}.t"
    write_layer(spark.range(3), table)
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('stop'), id) as id")
    with pytest.raises(Exception, match="stop"):
        write_layer(broken, table)
    assert spark.table(table).count() == 3
    write_layer(spark.range(5), table)
    assert spark.table(table).count() == 5


def test_key_counts_treat_null_as_a_value(spark):
    df = spark.sql("select * from values (1), (null), (null) as t(k)")
    r = Q.key_counts(df, ["k"]).first()
    assert (r.n_rows, r.n_keys, r.n_missing) == (3, 2, 2)
    report = {x.rule: x.n_failed for x in Q.check_keys(df, Q.KeyRule(("k",), 5)).collect()}
    assert report == {"row_count": 0, "null_keys": 2, "duplicate_keys": 1, "expected_count": 2}
    empty = Q.key_counts(df.filter("false"), ["k"]).first()
    assert (empty.n_rows, empty.n_keys, empty.n_missing) == (0, 0, 0)
    assert Q.duplicate_keys(df, ["k"]).collect() == [(None, 2)]


def test_row_rules(spark):
    df = spark.sql("select * from values (1, 2), (3, 2), (null, 2) as t(a, b)")
    rules = [Q.RowRule("a below b", "a < b"), Q.RowRule("big a", "b > 5", "a > 2")]
    got = [tuple(r) for r in Q.check_rows(df, rules).collect()]
    assert got == [("a below b", 3, 2, False), ("big a", 1, 1, False)]


def test_reference_check_with_a_hot_key(spark):
    child = spark.range(9000).selectExpr("if(id % 3 = 0, 1, id % 50) as k")
    parent = spark.range(40).selectExpr("id as pk")
    r = Q.check_reference(child, "k", parent, "pk", "known").first()
    want = child.filter("k >= 40").count()
    assert (r.n_rows, r.n_failed, r.passed) == (9000, want, False)


def test_lineage_of_files(spark, sf_dir):
    raw = read_landing(spark, f"{sf_dir}/events.parquet")
    out = L.to_bronze(raw, "b", at=AT)
    assert out.columns[: len(raw.columns)] == raw.columns
    r = out.select("_source_file", F.col("_ingested_at_utc").cast("string").alias("t")).first()
    assert (r[0], r.t) == ("events.parquet", "2024-03-01 04:05:06")
    assert L.batch_id(AT) == "20240301T040506Z"


def test_gate_reads_the_key_column_only(spark, schema):
    ensure_schema(spark, schema)
    write_layer(build_products(spark, 100), f"{schema}.p")
    silver = L.to_silver(spark.table(f"{schema}.p"))
    plan = Q.check_keys(silver, Q.KeyRule(("product_id",)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<product_id:string>" in text


def test_filters_reach_the_scan(spark, schema):
    write_layer(L.to_gold(L.to_silver(build_products(spark, 100))), f"{schema}.g")
    df = M.model_projection(spark.table(f"{schema}.g")).filter("is_perishable").select("name")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_perishable,true)" in text
    assert "ReadSchema: struct<name:string,is_perishable:boolean>" in text


def test_values_lost_by_casts_stop_the_silver_gate(spark, tmp_path):
    cfg = config(tmp_path, "casts", expected_rows=None)
    rows = build_products(spark, 60)
    lost = rows.withColumn("cost_price_aud", F.expr("if(product_id = 'P000007', 1e9D, cost_price_aud)"))
    write_rows(lost, cfg.landing)
    with pytest.raises(Q.GateFailed, match="cast keeps cost_price_aud: 1 of 60"):
        run_layers(spark, cfg)
    assert not spark.catalog.tableExists(f"{cfg.silver}.{cfg.table}")
    free = config(tmp_path, "nogates", gates=False)
    run_layers(spark, free)
    silver = read_layer(spark, free.silver, free.table)
    assert silver.filter("cost_price_aud is null").count() == 1


def test_bad_gold_batch_leaves_gold_unchanged(spark, tmp_path):
    cfg = config(tmp_path, "goldgate", expected_rows=None)
    write_rows(build_products(spark, 60), cfg.landing)
    run_layers(spark, cfg)
    before = sorted(read_layer(spark, cfg.gold, cfg.table).collect(), key=str)
    silver = read_layer(spark, cfg.silver, cfg.table)
    bad = silver.withColumn("retail_price_aud", F.expr("retail_price_aud * 0").cast("decimal(10,2)"))
    write_layer(bad, f"{cfg.silver}.{cfg.table}")
    with pytest.raises(Q.GateFailed, match="gold gate: margin known"):
        run_gold(spark, cfg)
    assert sorted(read_layer(spark, cfg.gold, cfg.table).collect(), key=str) == before


def test_empty_landing_stops_at_bronze(spark, tmp_path):
    cfg = config(tmp_path, "nothing")
    write_rows(build_products(spark, 10).limit(0), cfg.landing)
    with pytest.raises(Q.GateFailed, match="bronze gate"):
        run_layers(spark, cfg)


def test_a_write_that_dies_before_the_switch(spark, schema, monkeypatch):
    """Half way: the new version is complete, the view still shows the old one; the next write goes through."""
    table = f"{schema}.t"
    write_layer(spark.range(3), table)
    real = type(spark).sql

    def dies(self, text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("killed")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", dies)
    with pytest.raises(RuntimeError, match="killed"):
        write_layer(spark.range(5), table)
    monkeypatch.undo()
    assert spark.table(table).count() == 3
    started = spark.table(table).filter("id >= 0")
    write_layer(spark.range(7), table)
    assert started.count() == 3 and spark.table(table).count() == 7


def test_columns_with_dots_pass_bronze(spark):
    raw = spark.sql("select 1 as `a.b`, 2 as c")
    assert L.to_bronze(raw, "b", "f").select("`a.b`", "c").first() == (1, 2)


def test_rule_names_may_hold_quotes(spark):
    df = spark.sql("select 1 as a")
    assert Q.check_rows(df, [Q.RowRule("it's \\ so", "a > 1")]).first().rule == "it's \\ so"


def test_plain_counts_shuffle_no_key(spark):
    df = spark.range(100).selectExpr("if(id = 3, null, id % 7) as k")
    counted = Q.check_counts(df, Q.KeyRule(("k",), 100))
    assert {r.rule: r.n_failed for r in counted.collect()} == {"row_count": 0, "null_keys": 1, "expected_count": 0}
    assert "hashpartitioning" not in counted._jdf.queryExecution().executedPlan().toString()


def test_groups_without_a_target_fail(spark):
    df = spark.sql("select * from values ('a'), ('a'), ('b'), (null) as t(g)")
    goal = spark.sql("select 'a' as g, 2 as goal union all select 'c', 5")
    got = {r.rule: (r.n_rows, r.n_failed, r.passed) for r in Q.check_group_share(df, "g", goal, "goal").collect()}
    assert got == {
        "share of a": (2, 0, True), "share of b": (1, 1, False), "share of c": (0, 5, False),
        "share of NULL": (1, 1, False),
    }


def test_repeated_lookup_keys_are_refused(spark):
    own = spark.sql("select 'Bread' as category, 3D as shelf_life_days, 0.1D as wastage_rate")
    more = own.unionByName(own.withColumn("shelf_life_days", F.lit(9.0)))
    with pytest.raises(ValueError, match="Bread"):
        Lookups(spark, {"shelf_life": more})
