"""One order, customer and product hold a third of everything; results must stay whole."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martflow.operators import customers, marts, promotions, quality
from martflow.sources.raw import item_level


@pytest.fixture
def split_hot_partitions(spark):
    """Thresholds so low that adaptive execution treats the small hot partitions as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def hot(split_hot_partitions):
    spark = split_hot_partitions
    n = 3000
    first = date(2018, 1, 1)
    orders = [(i, first + timedelta(i % 400), 1 if i % 3 == 0 else i % 97, i % 5, "delivered", "card") for i in range(n)]
    items = [
        (0 if i % 3 == 0 else i % n, 7 if i % 3 == 0 else i % 50, 1 + i % 4, 10.0, 1.0, "P" if i % 2 else None, None)
        for i in range(2 * n)
    ]
    returns = [(i, 0, 7, first + timedelta(i % 30), "defective" if i % 2 else "wrong_size", 1, 2.0) for i in range(1000)]
    return {
        "orders": spark.createDataFrame(orders, "order_id bigint, order_date date, customer_id bigint, zip bigint, order_status string, payment_method string").repartition(6),
        "items": spark.createDataFrame(items, "order_id bigint, product_id bigint, quantity int, unit_price double, discount_amount double, promo_id string, promo_id_2 string").repartition(6),
        "returns": spark.createDataFrame(returns, "return_id bigint, order_id bigint, product_id bigint, return_date date, return_reason string, return_quantity int, refund_amount double").repartition(6),
        "reviews": spark.createDataFrame([(1, 0, 7, 1, first, 5)], "review_id bigint, order_id bigint, product_id bigint, customer_id bigint, review_date date, rating int"),
        "products": spark.createDataFrame([(i, f"p{i}", f"c{i % 3}", 20.0, 4.0) for i in range(50)], "product_id bigint, product_name string, category string, price double, cogs double"),
    }


def test_hot_line_keeps_every_row(hot):
    lines = marts.item_measures(hot["items"], hot["products"], hot["returns"], hot["reviews"])
    row = lines.agg(F.count("*"), F.sum("quantity"), F.count_if("is_returned"), F.sum("line_revenue")).first()
    quantity = sum(1 + i % 4 for i in range(6000))
    assert tuple(row) == (6000, quantity, 2000, quantity * 10.0)
    agg = marts.returns_agg(hot["returns"]).first()
    assert (agg["return_records"], agg["top_return_reason"]) == (1000, "defective")


def test_hot_order_and_product_totals(hot):
    lines = marts.item_measures(hot["items"], hot["products"], hot["returns"], hot["reviews"])
    orders = marts.order_outcomes(hot["orders"], lines)
    assert orders.count() == 3000
    assert orders.where("order_id = 0").first()["order_items"] == 2000
    assert marts.product_totals(hot["products"], lines).agg(F.sum("item_lines")).first()[0] == 6000


def test_hot_customer_repurchases(hot):
    items = item_level(hot["items"], hot["orders"], hot["products"])
    effect = {r["promo_used"]: r for r in promotions.promo_effect(items, 2018, 2019).collect()}
    level = promotions.promo_order_level(promotions.sold_lines(items, 2018, 2019))
    assert sum(r["orders"] for r in effect.values()) == level.count()
    assert customers.order_gap_counts(hot["orders"]).agg(F.sum("n")).first()[0] == 3000 - 97
    assert quality.foreign_key_coverage(hot["items"], hot["orders"], "order_id", "order_id").first()["child_non_null_rows"] == 6000
