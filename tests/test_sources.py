from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest

from martflow.sources import raw, writers
from martflow.sources.schema import RAW_TABLES


def test_csv_types_gaps_and_headers(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        " order_id ,order_date,customer_id,zip,order_status,payment_method,extra\n"
        "1,2020-01-02,3.0,100,shipped,NaN,x\n"
        "2,2020-01-03 00:00:00,,bad,NA,card,y\n"
        "3,oops,7,5,,card,z\n"
    )
    df = raw.load_table(spark, "orders", str(tmp_path))
    assert dict(df.dtypes)["order_id"] == "bigint" and dict(df.dtypes)["extra"] == "string"
    rows = {r["order_id"]: r for r in df.collect()}
    assert (rows[1]["order_date"], rows[1]["customer_id"], rows[1]["payment_method"]) == (date(2020, 1, 2), 3, None)
    assert (rows[2]["order_date"], rows[2]["customer_id"], rows[2]["zip"], rows[2]["order_status"]) == (date(2020, 1, 3), None, None, None)
    assert rows[3]["order_date"] is None and rows[3]["order_status"] is None


def test_nan_money_becomes_null(spark, tmp_path):
    (tmp_path / "sales.csv").write_text("Date,Revenue,COGS\n2020-01-01,NaN,1.5\n2020-01-02,2,x\n")
    rows = raw.load_table(spark, "sales.csv", str(tmp_path)).orderBy("Date").collect()
    assert [(r["Revenue"], r["COGS"]) for r in rows] == [(None, 1.5), (2.0, None)]


def test_missing_files_are_listed_together(spark, tmp_path):
    (tmp_path / "sales.csv").write_text("Date,Revenue,COGS\n")
    with pytest.raises(FileNotFoundError) as error:
        raw.load_raw_data(spark, str(tmp_path))
    assert str(error.value).count(".csv") == len(RAW_TABLES) - 1 and "sales.csv" not in str(error.value)
    with pytest.raises(FileNotFoundError, match="no CSV file"):
        raw.read_csv(spark, str(tmp_path / "no.csv"))


def test_item_level_keeps_given_measures(shop, spark):
    given = shop["order_items"].withColumn("net_item_revenue", shop["order_items"]["quantity"] * 1.0)
    rows = raw.item_level(given, shop["orders"], shop["products"]).collect()
    assert {r["net_item_revenue"] for r in rows if r["order_id"] == 3} == {3.0}
    plain = raw.item_level(shop["order_items"].drop("promo_id", "promo_id_2"), shop["orders"], shop["products"])
    assert {(r["order_id"], r["promo_used_flag"]) for r in plain.collect() if r["order_id"] in (3, 4)} == {(3, 1), (4, 0)}
    with pytest.raises(ValueError, match="cogs"):
        raw.item_level(shop["order_items"], shop["orders"], shop["products"].drop("cogs"))


def test_order_level_sums_payments(shop):
    twice = shop["payments"].union(shop["payments"])
    rows = {r["order_id"]: r["payment_value"] for r in raw.order_level(shop["orders"], twice).collect()}
    assert rows == {1: 58.0, 2: 40.0, 3: 50.0, 4: 0.0, 5: 0.0, 6: 0.0}
    with pytest.raises(ValueError, match="payment_value"):
        raw.order_level(shop["orders"], shop["payments"].drop("payment_value"))


def test_layers_partition_and_read_back(spark, shop, tmp_path):
    back = writers.save_layer(shop["orders"], str(tmp_path), "orders", month_of="order_date")
    assert back.columns == shop["orders"].columns and back.count() == 6
    assert {p.name for p in (tmp_path / "orders").iterdir() if p.is_dir()} >= {"month_part=2018-01", "month_part=2019-02"}
    assert writers.save_layer(shop["geography"], str(tmp_path), "geo").count() == 2


def test_metrics_and_csv_sinks(spark, shop, tmp_path):
    writers.save_metrics(spark.createDataFrame([(1.5, "x")], "a double, b string"), str(tmp_path / "m"))
    part = next((tmp_path / "m").glob("part-*"))
    assert json.loads(part.read_text()) == {"a": 1.5, "b": "x"}
    paths = writers.save_many({"geo": shop["geography"], "pay.csv": shop["payments"]}, str(tmp_path / "out"))
    assert [Path(p).name for p in paths] == ["geo.csv", "pay.csv"]
    assert spark.read.option("header", True).csv(paths[1]).count() == 5


def test_submission_file_is_ordered_and_rounded(spark, tmp_path):
    df = spark.createDataFrame([(date(2023, 1, 2), 2.125, 1.0), (date(2023, 1, 1), 1.0, 0.5)], "Date date, Revenue double, COGS double")
    writers.save_submission(df, str(tmp_path / "s"))
    parts = list((tmp_path / "s").glob("part-*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == ["Date,Revenue,COGS", "2023-01-01,1.0,0.5", "2023-01-02,2.12,1.0"]
