"""Tasks over dense rows: sizes of the session that queries run in, and shuffles of the facts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martflow.operators import marts
from martflow.session import ROWS_A_PARTITION, sized_session

KEYS = {
    "spark.sql.shuffle.partitions": "3",
    "spark.sql.files.maxPartitionBytes": "1m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def given(spark):
    before = {k: spark.conf.get(k, None) for k in KEYS}
    for k, v in KEYS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_partitions_follow_the_rows_and_the_given_session_stays(given):
    own = sized_session(given, 10 * ROWS_A_PARTITION + 1)
    assert own.conf.get("spark.sql.shuffle.partitions") == "11"
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "1m"  # smaller already
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert sized_session(given, 0).conf.get("spark.sql.shuffle.partitions") == "3"
    assert {k: given.conf.get(k) for k in KEYS} == KEYS


def test_lines_by_order_are_not_shuffled_again_by_product(given):
    spark = sized_session(given, 0)
    lines = spark.range(2000).selectExpr(
        "id % 500 as order_id", "id % 7 as product_id", "1.0D * (id % 3) as quantity", "2.0D as unit_price", "0.0D as discount_amount",
        "case when id % 2 = 0 then 'P' end as promo_id", "cast(null as string) as promo_id_2",
    )
    orders = spark.range(500).selectExpr("id as order_id", "date '2018-01-01' as order_date", "id % 9 as customer_id", "id % 4 as zip")
    products = spark.range(6).selectExpr("id as product_id", "concat('p', id) as product_name", "3.0D as price", "1.0D as cogs")
    returns = lines.where("quantity = 2").selectExpr(
        "order_id * 7 + product_id as return_id", "order_id", "product_id", "date '2018-02-01' as return_date", "'a' as return_reason",
        "1 as return_quantity", "1.5D as refund_amount",
    )
    reviews = lines.where("quantity = 1").selectExpr(
        "order_id * 7 + product_id as review_id", "order_id", "product_id", "date '2018-02-02' as review_date", "4 as rating"
    )
    customers = spark.range(9).selectExpr("id as customer_id", "'x' as age_group")
    geography = spark.range(4).selectExpr("id as zip", "'r' as region")
    payments = orders.selectExpr("order_id", "5.0D as payment_value", "1 as installments")
    shipments = orders.selectExpr("order_id", "order_date as ship_date", "order_date as delivery_date", "0.5D as shipping_fee")
    light = marts.order_line_fact(lines, orders, products, payments, shipments, returns, reviews, checked=False)
    full = marts.item_fact(lines, orders, products, customers, geography, payments, shipments, returns, reviews, checked=False)
    for fact in (light, full):
        plan = fact._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert moved and not any("order_id" in x and "product_id" in x and "unit_price" in x for x in moved)
        # lines travel by product, then by order; every further join finds them in place
        assert sum("hashpartitioning(product_id" in x for x in moved) == 2
        row = fact.agg(F.count(F.lit(1)), F.sum("line_revenue"), F.count("order_date"), F.sum("return_quantity"), F.count("product_name")).first()
        known = 2000 - sum(i % 7 == 6 for i in range(2000))
        per_key = {}
        for i in range(2000):
            if i % 3 == 2:
                per_key[i % 500, i % 7] = per_key.get((i % 500, i % 7), 0) + 1
        returned = sum(per_key.get((i % 500, i % 7), 0) for i in range(2000))
        assert tuple(row) == (2000, sum(2.0 * (i % 3) for i in range(2000)), 2000, returned, known)
    placed = [c for c in marts.order_context(orders, customers, geography, payments, shipments, checked=False).columns if c != "order_id"]
    assert full.columns == [
        "order_id", "product_id", "quantity", "unit_price", "discount_amount", "promo_id", "promo_id_2", "product_name", "price", "cogs",
        "return_records", "return_quantity", "refund_amount", "first_return_date", "top_return_reason", "review_records", "avg_rating",
        "first_review_date", "line_revenue", "line_cogs", "gross_profit", "gross_margin", "has_promo", "is_returned", *placed, "order_month",
    ]
