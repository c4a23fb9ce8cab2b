from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martflow.operators import joins


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (None, "w")], "k int, v string")
    return left, right


def test_left_rows_are_kept_and_overlaps_renamed(sides):
    left, right = sides
    out = joins.checked_left_join(left, right, "k", suffix="_r")
    assert out.columns == ["k", "v", "v_r"]
    assert sorted((r["v"], r["v_r"]) for r in out.collect()) == [("a", "x"), ("b", "x"), ("c", "y"), ("d", None), ("e", None)]


def test_duplicate_right_key_fails_the_query(sides):
    left, right = sides
    out = joins.checked_left_join(left, right.union(right), "k")
    with pytest.raises(Exception, match="not unique in the right table"):
        out.collect()


def test_one_to_one_checks_the_left_side_too(sides):
    left, right = sides
    with pytest.raises(Exception, match="not unique in the left table"):
        joins.checked_left_join(left, right, "k", "1:1").collect()


def test_unchecked_join_may_grow(sides):
    left, right = sides
    assert joins.checked_left_join(left, right.union(right), "k", None).count() == 8


def test_status_column(sides):
    left, right = sides
    out = joins.left_join_with_status(left, right, "k", "status")
    assert {r["v"]: r["status"] for r in out.collect()} == {
        "a": "both", "b": "both", "c": "both", "d": "left_only", "e": "left_only",
    }


def test_growth_equals_the_real_join(spark):
    left = spark.createDataFrame([(i % 3,) for i in range(30)] + [(77,), (None,)], "k int")
    right = spark.createDataFrame([(0,), (0,), (1,), (5,), (None,)], "k int")
    row = joins.join_growth("x", left, right, "k", "m:1").first()
    assert (row["left_rows"], row["right_rows"]) == (32, 5)
    assert row["output_rows"] == left.join(right, "k", "left").count() == 42
    assert row["status"] == "CHECK"
    assert joins.join_growth("x", left, right, "k", "1:n allowed").first()["status"] == "PASS"


def test_hot_key_is_one_row_after_counting(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    right = left.distinct()
    row = joins.join_growth("x", left, right, "k", "m:1").first()
    assert (row["output_rows"], row["status"]) == (9000, "PASS")


def test_slot_lookup_falls_back(spark):
    days = spark.createDataFrame([(2, 29), (3, 1)], "Month int, Day int")
    profile = spark.createDataFrame([(3, 1, 5.0)], "Month int, Day int, value double")
    out = joins.slot_lookup(days, profile, ["Month", "Day"], {"value": F.lit(7.0)})
    assert {(r["Month"], r["Day"]): r["value"] for r in out.collect()} == {(2, 29): 7.0, (3, 1): 5.0}


def test_order_joins_of_the_shop(shop):
    paid = {r["order_id"]: r for r in joins.orders_payments(shop["orders"], shop["payments"]).collect()}
    assert paid[6]["payment_join_status"] == "left_only" and paid[1]["payment_method_payment"] == "card"
    placed = {r["order_id"]: r["geo_join_status"] for r in joins.orders_geography(shop["orders"], shop["geography"]).collect()}
    assert placed[6] == "left_only"
    sent = {r["order_id"]: r for r in joins.orders_shipments(shop["orders"], shop["shipments"]).collect()}
    assert (sent[1]["ship_lead_days"], sent[1]["delivery_lead_days"]) == (1, 4)
    assert sent[5]["shipment_join_status"] == "left_only" and sent[5]["ship_lead_days"] is None


def test_owners_are_checked_instead_of_the_sides(sides, spark):
    left, right = sides
    good, bad = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int"), spark.createDataFrame([(1,), (1,)], "k int")
    out = joins.checked_left_join(left, right, "k", "1:1", owners={"good": (good, ["k"])})
    assert out.count() == 5
    out = joins.checked_left_join(left, right, "k", owners={"good": (good, ["k"]), "bad": (bad, ["k"])})
    with pytest.raises(Exception, match="not unique in bad"):
        out.collect()
    assert joins.checked_left_join(left, right, "k", owners={}).count() == 5


def test_owner_check_does_not_compute_a_side_again(spark, tmp_path):
    spark.range(20).selectExpr("id as k", "id % 5 as c").write.parquet(str(tmp_path / "orders"))
    spark.range(5).selectExpr("id as c", "'x' as place").write.parquet(str(tmp_path / "customers"))
    read = lambda t: spark.read.parquet(str(tmp_path / t))
    view = read("orders").join(read("customers"), "c", "left")
    lines = spark.range(50).selectExpr("id % 20 as k")
    out = joins.items_orders(lines.withColumnRenamed("k", "order_id"), view.withColumnRenamed("k", "order_id"), {"o": (read("orders").select("k"), ["k"]), "c": (read("customers").select("c"), ["c"])})
    assert out.count() == 50
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 4


def test_lines_with_their_returns_reviews_and_promotions(shop):
    returned = joins.items_returns(shop["order_items"], shop["returns"]).collect()
    assert sorted((r["order_id"], r["return_id"]) for r in returned if r["return_id"]) == [(1, "r3"), (1, "r3"), (3, "r1"), (3, "r2")]
    assert len(returned) == 7 and {r["return_join_status"] for r in returned if r["return_id"] is None} == {"left_only"}
    reviewed = joins.items_reviews(shop["order_items"], shop["reviews"])
    assert reviewed.count() == 8 and reviewed.where("review_join_status = 'both'").count() == 5
    assert [r["order_id"] for r in joins.items_double_promotions(shop["order_items"]).collect()] == [3]
