from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from martflow.operators import joins, marts, models, quality
from martflow.plans import answers, audit, build_marts, forecasting, layers, queries_audit
from martflow.sources.raw import load_raw_data
from martflow.sources.retail_views import RetailViews
from martflow.sources.schema import EXPECTED_GRAIN
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not SF_SMALL.exists(), reason="test tables are not here")
PERIODS = answers.Periods(1995, 1998, 2001)
TINY = models.EnsembleSize(boosted_rounds=2, forest_trees=3, depth=3, step=0.3, seeds=(1,), threads=4)


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    """The small test tables written as raw CSV files, one row per key."""
    out = tmp_path_factory.mktemp("raw")
    views = RetailViews(spark, str(SF_SMALL))
    tables = views.tables()
    tables["returns"] = tables["returns"].dropDuplicates(["return_id"])
    tables["inventory"] = tables["inventory"].withColumns({"year": F.year("snapshot_date"), "month": F.month("snapshot_date")})
    sales = tables["sales"]
    tables["sales"] = sales.where("Date < '2001-01-01'")
    tables["sample_submission"] = sales.where("Date >= '2001-01-01'")
    tables["promotions"] = spark.createDataFrame([("P5", "1995-01-01", "1995-02-01", None)], "promo_id string, start_date string, end_date string, applicable_category string")
    for name, df in tables.items():
        df.write.option("header", True).csv(f"{out}/{name}.csv")
    return str(out)


@pytest.fixture(scope="module")
def tables(spark, raw_dir):
    return load_raw_data(spark, raw_dir)


def test_build_writes_consistent_layers(spark, raw_dir, tmp_path):
    built = build_marts.run(spark, raw_dir, str(tmp_path))
    assert set(built) == {
        "item_fact", "order_fact", "customer_360", "product_360", "daily_panel", "product_month_panel",
        "order_line_fact", "customer_mart", "product_mart", "daily_business_panel",
    }
    lines = built["item_fact"].count()
    assert lines == 6000 == built["order_line_fact"].count()
    total = built["item_fact"].agg(F.sum("line_revenue")).first()[0]
    for name, column in (("order_fact", "order_revenue_from_items"), ("customer_360", "total_revenue"), ("product_360", "revenue"), ("product_mart", "revenue")):
        assert built[name].agg(F.sum(column)).first()[0] == pytest.approx(total), name
    checks = spark.read.option("header", True).csv(f"{tmp_path}/reports/output_datamart_checks")
    assert {r["status"] for r in checks.collect()} == {"PASS"} and checks.count() == 6
    read = lambda name: spark.read.option("header", True).csv(f"{tmp_path}/reports/{name}").collect()
    verdicts = {r["table"]: r for r in read("audit_conclusion")}
    assert set(verdicts) == set(EXPECTED_GRAIN) and len(verdicts) == 15
    assert verdicts["order_fact"]["grain_check"] == "PASS" and verdicts["daily_panel"]["overall_status"] == "PASS"
    assert {r["key_state"] for r in verdicts.values()} == {"checked"}
    classes = {(r["table"], r["column"]): r for r in read("null_classes")}
    assert classes["items_returns", "return_id"]["null_class"] == "structural_null" and int(classes["items_returns", "return_id"]["null_count"]) > 0
    assert {t for t, _ in classes} == set(verdicts) == {r["table"] for r in read("audit_overview")} == {r["table"] for r in read("null_audit_detail")}


def test_refreshed_months_equal_a_whole_build(spark, tables, tmp_path):
    before, out = dict(tables), str(tmp_path / "a")
    build_marts.build_facts(before, f"{out}/interim")
    # one month gains lines and loses an order, one loses all its orders, the others must not be touched
    months = ["1996-03", "1997-05"]
    month = F.date_format("order_date", "yyyy-MM")
    march = [r["order_id"] for r in tables["orders"].where(month == "1996-03").select("order_id").orderBy("order_id").limit(2).collect()]
    more = tables["order_items"].where(F.col("order_id") == march[1]).withColumn("quantity", F.col("quantity") + 1)
    changed = {
        **tables,
        "orders": tables["orders"].where((month != "1997-05") & (F.col("order_id") != march[0])),
        "order_items": tables["order_items"].unionByName(more),
    }
    untouched = sorted(p.name for p in (tmp_path / "a/interim/item_fact/month_part=1996-04").iterdir())
    items, orders = build_marts.refresh_facts(changed, out, months)
    assert sorted(p.name for p in (tmp_path / "a/interim/item_fact/month_part=1996-04").iterdir()) == untouched
    whole_items, whole_orders = build_marts.build_facts(changed, str(tmp_path / "b/interim"))
    rows = lambda df: sorted(map(repr, df.where(F.col("order_date").isNotNull()).select(*sorted(df.columns)).collect()))
    assert rows(items) == rows(whole_items) and rows(orders) == rows(whole_orders)
    assert orders.where(month == "1997-05").count() == 0 < orders.where(month == "1996-03").count()


def test_bucketed_tables_join_without_a_shuffle(spark, tables, tmp_path):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed = build_marts.bucket_by_order(tables, str(tmp_path), 4)
        joined = joins.items_orders(bucketed["order_items"], bucketed["orders"], checked=False)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" not in bucketed["order_items"].groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
        plain = joins.items_orders(tables["order_items"], tables["orders"], checked=False)
        assert sorted(map(repr, joined.select(*sorted(joined.columns)).collect())) == sorted(map(repr, plain.select(*sorted(plain.columns)).collect()))
        fact = lambda t: marts.item_fact(*(t[n] for n in ("order_items", "orders", "products", "customers", "geography", "payments", "shipments", "returns", "reviews")), checked=False)
        a, b = fact(bucketed), fact(tables)
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert exchanges(a) < exchanges(b)
        assert a.agg(F.count("*"), F.round(F.sum("line_revenue"), 2)).first() == b.agg(F.count("*"), F.round(F.sum("line_revenue"), 2)).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_a_table_with_a_hot_order_is_not_bucketed(spark, tables, tmp_path):
    hot = {**tables, "order_items": tables["order_items"].withColumn("order_id", F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("order_id")))}
    bucketed = build_marts.bucket_by_order(hot, str(tmp_path), 2, hot_rows=100)
    assert bucketed["order_items"] is hot["order_items"] and bucketed["orders"] is not hot["orders"]


def test_audited_columns_are_those_of_the_tables(spark):
    v = RetailViews(spark, str(SF_SMALL))
    tables = queries_audit.audited_tables(v, queries_audit.layer_of(v))
    assert {name: sorted(df.columns) for name, df in tables.items()} == {name: sorted(c.split()) for name, c in queries_audit.AUDITED_COLUMNS.items()}


def test_layers_leave_no_shuffles_and_profile_one_table_at_a_time(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in disk.getAllFiles().mkString("|").split("|") if "/shuffle_" in f}
    before, layer = shuffles(), layers.Layer(spark, [str(tmp_path / "in")])
    tables = {"a": spark.range(900).select((F.col("id") % 300).alias("k")), "b": spark.range(40).select(F.col("id").cast("string").alias("k"))}
    found = queries_audit.profiled(layer, "profile", tables, {"a": ["k"], "b": ["k"]})
    # what the last table was shuffled through may go with the next one
    for k in range(20):
        layer.table(f"next-{k}", lambda: spark.range(1))
        time.sleep(0.2)
        if not shuffles() - before:
            break
    assert not shuffles() - before
    together = quality.table_profiles(tables, {"a": ["k"], "b": ["k"]})
    assert sorted(found.collect()) == sorted(together.collect())
    assert [layer.table(f"profile-{t}", lambda: None).count() for t in tables] == [1, 1]


def test_layers_are_built_once_for_the_same_files(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    def table(n):
        return layers.Layer(spark, [str(tmp_path / "in")]).table("t", lambda: build(n)).count()

    assert (table(3), table(4), built) == (3, 3, [3])
    spark.range(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert (table(4), built) == (4, [3, 4])


def test_a_layer_that_did_not_end_is_built_anew(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    layer = layers.Layer(spark, [str(tmp_path / "in")])
    with pytest.raises(Exception, match="boom"):
        layer.table("t", lambda: spark.range(3).select(F.raise_error(F.lit("boom"))))
    assert layer.table("t", lambda: spark.range(3)).count() == 3


def test_audit_writes_four_reports(spark, raw_dir, tmp_path):
    paths = audit.run(spark, raw_dir, str(tmp_path))
    counts = [spark.read.option("header", True).csv(p).count() for p in paths]
    assert counts == [3, 8, 12, 11]


@pytest.mark.parametrize("variant", forecasting.VARIANTS)
def test_forecast_run_passes_its_contract(spark, raw_dir, tmp_path, variant):
    path = forecasting.run(spark, raw_dir, str(tmp_path), variant, TINY, PERIODS)
    rows = spark.read.option("header", True).option("inferSchema", True).csv(path)
    stats = rows.agg(F.count("*").alias("n"), F.min("Revenue").alias("r"), F.min("COGS").alias("c")).first()
    assert stats["n"] == 83 and stats["r"] >= 0 and stats["c"] >= 0
    features = 33 if variant == "slots" else 39
    assert spark.read.option("header", True).csv(f"{tmp_path}/feature_importance").count() == features


def test_unknown_variant_is_refused(tables):
    with pytest.raises(ValueError, match="variant"):
        forecasting.forecast_days(tables, "other")


def test_backtest_rebuilds_profiles_per_fold(tables):
    rows = forecasting.rolling_backtest(tables["sales"], n_splits=2, valid_days=30).collect()
    assert {(r["model"], r["fold"]) for r in rows} == {(m, f) for m in ("seasonal_profiles", "seasonal_naive", "moving_average") for f in (1, 2)}
    assert all(r["MAE"] > 0 for r in rows)


def test_story_metrics(tables, tmp_path):
    forecast = tables["sales"].select("Date", "Revenue")
    answers.write_story_metrics(tables, forecast, str(tmp_path / "story"), PERIODS, ("2000-01-01", "2000-07-01"))
    story = json.loads(next((tmp_path / "story").glob("part-*")).read_text())
    assert {k[:2] for k in story} == {"a3", "a4", "a6"} and story["a6_cr_retention_target_mn"] == 1085.0
    answers.write_patch_metrics(tables, str(tmp_path / "patch"), PERIODS)
    patch = json.loads(next((tmp_path / "patch").glob("part-*")).read_text())
    assert patch["a3_promo_revenue_share_pct"] == pytest.approx(story["a3_promo_revenue_share_pct"])
    assert answers.a5_sku_actions(tables, PERIODS).first()["refill_sku_count"] >= 0
    assert answers.a2_customers(tables, PERIODS).first()["repeat_rate_change_pp"] is not None
