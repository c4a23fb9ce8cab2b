from __future__ import annotations

from datetime import date

import pytest

from martflow.operators import joins, quality
from tests.conftest import by_key


def test_null_report_lists_only_gaps(shop):
    rows = by_key(quality.null_report({"order_items": shop["order_items"], "geography": shop["geography"]}), "table", "column")
    assert set(rows) == {("order_items", "promo_id"), ("order_items", "promo_id_2")}
    assert rows["order_items", "promo_id"]["null_count"] == 4
    assert rows["order_items", "promo_id"]["null_rate"] == 4 / 6


def test_column_profile(shop):
    rows = by_key(quality.column_profile(shop["customers"], "customers"), "column")
    assert (rows["gender"]["null_count"], rows["gender"]["null_pct"], rows["gender"]["n_unique"]) == (1, 33.33, 2)
    assert (rows["zip"]["n_unique"], rows["zip"]["dtype"]) == (2, "bigint")
    assert len(rows) == len(shop["customers"].columns)


def test_duplicate_keys_and_missing_columns(shop):
    tables = {"orders": shop["orders"].union(shop["orders"].limit(1)), "customers": shop["customers"].drop("customer_id"), "geography": shop["geography"]}
    rows = by_key(quality.duplicate_key_report(tables), "table")
    assert (rows["orders"]["status"], rows["orders"]["duplicate_rows"]) == ("FAIL", 1)
    assert (rows["customers"]["status"], rows["customers"]["duplicate_rows"]) == ("MISSING_COLUMNS", None)
    assert rows["geography"]["status"] == "PASS"


def test_key_profile_counts_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (None, "a"), (1, "b")], "k int, j string")
    row = quality.key_profile(df, "t", ["k", "j"], True).first()
    assert (row["rows"], row["distinct_keys"], row["duplicate_key_rows"], row["null_key_rows"], row["status"]) == (4, 3, 1, 2, "CHECK")
    assert quality.key_profile(df.where("k is not null"), "t", ["k", "j"], True).first()["status"] == "PASS"


def test_candidate_keys(shop):
    rows = by_key(quality.candidate_keys(shop["order_items"]), "candidate_key")
    assert rows["order_id, product_id"]["duplicate_rows"] == 1
    assert rows["order_id, product_id, unit_price, discount_amount"]["duplicate_rows"] == 0


def test_duplicate_rows_keep_every_row(shop):
    assert quality.duplicate_rows(shop["order_items"], ["order_id", "product_id"]).count() == 2
    assert quality.duplicate_groups(shop["order_items"], ["order_id", "product_id"]).first()["n_rows"] == 2


def test_foreign_keys(shop):
    rows = by_key(quality.relationship_report(shop), "child_table", "parent_table")
    assert rows["orders", "geography"]["missing_fk_rows"] == 1 and rows["orders", "geography"]["status"] == "WARN"
    assert rows["orders", "geography"]["coverage_rate"] == 1 - 1 / 6
    assert rows["order_items", "orders"]["status"] == "PASS"
    empty = quality.foreign_key_coverage(shop["orders"].limit(0), shop["customers"], "customer_id", "customer_id").first()
    assert (empty["child_non_null_rows"], empty["coverage_rate"], empty["status"]) == (0, 1.0, "PASS")


def test_date_ranges_with_unreadable_text(spark):
    df = spark.createDataFrame([("2020-01-05",), ("oops",), (None,), ("2019-12-31",)], "order_date string")
    row = quality.date_range_report({"orders": df}).first()
    assert (row["min_date"], row["max_date"], row["null_dates"], row["rows"]) == (date(2019, 12, 31), date(2020, 1, 5), 2, 4)


def test_future_dates(spark):
    df = spark.createDataFrame([(date(2024, 7, 1),)], "d date")
    assert quality.no_future_dates(df, "d").first()[0] is True
    assert quality.no_future_dates(df, "d", "2024-06-30").first()[0] is False
    assert quality.no_future_dates(df.selectExpr("cast(null as date) d"), "d").first()[0] is False


def test_reconciliation(shop):
    row = quality.order_payment_reconciliation(shop["orders"], shop["payments"]).first()
    assert tuple(row) == (6, 5, 1, 0, "WARN")
    assert quality.order_payment_reconciliation(shop["orders"], shop["orders"]).first()["status"] == "PASS"


def test_business_rules(shop):
    margin = by_key(quality.product_margin_rule(shop["products"]), "product_id")
    assert (margin[1]["gross_margin_pct"], margin[1]["rule_cogs_lt_price"]) == (0.4, True)
    assert margin[2]["rule_cogs_lt_price"] is False and margin[3]["gross_margin_pct"] is None
    status = by_key(quality.shipment_status_rule(shop["orders"], shop["shipments"]), "order_id")
    assert status[1]["allowed_status"] is True and status[4]["allowed_status"] is False
    row = quality.shipment_violations(joins.orders_shipments(shop["orders"], shop["shipments"])).first()
    assert tuple(row) == (2, 1)


def test_missing_payments(shop):
    rows = quality.missing_payment_rows(joins.orders_payments(shop["orders"], shop["payments"])).collect()
    assert sorted(r["order_id"] for r in rows) == [4, 6]


def test_missing_shipments(shop):
    rows = quality.missing_shipment_rows(joins.orders_shipments(shop["orders"], shop["shipments"])).collect()
    assert sorted(r["order_id"] for r in rows) == [5, 6]


def test_audit_overview_counts_repeated_rows(shop):
    doubled = shop["payments"].union(shop["payments"])
    row = quality.audit_overview({"payments": doubled}).first()
    assert (row["rows"], row["cols"], row["total_null_values"], row["duplicate_rows"], row["duplicate_row_pct"]) == (10, 4, 2, 5, 50.0)
    assert row["null_density_pct"] == 5.0


def test_verdicts(spark):
    rules = {"t": {"unexpected": ["a", "b", "c"], "structural": ["s"]}}
    good = spark.createDataFrame([(1, 1, 1, 1, None)], "k int, a int, b int, c int, s int")
    row = quality.table_verdict(good, "t", ["k"], rules).first()
    assert (row["grain_check"], row["null_risk"], row["overall_status"], row["notes"]) == ("PASS", "PASS", "PASS", quality.STRUCTURAL_NOTE)
    warn = spark.createDataFrame([(1, None, 1, 1, 1), (1, 1, 1, 1, 1)], good.schema)
    row = quality.table_verdict(warn, "t", ["k"], rules).first()
    assert (row["grain_check"], row["null_risk"], row["overall_status"]) == ("WARN", "WARN", "WARN")
    assert row["notes"] == "duplicate by expected grain = 1 | unexpected null in: a"
    fail = spark.createDataFrame([(1, None, None, None, 1)] * 22, good.schema)
    row = quality.table_verdict(fail, "t", ["k"], rules).first()
    assert (row["grain_check"], row["null_risk"], row["overall_status"], row["duplicate_key_rows"]) == ("FAIL", "FAIL", "FAIL", 21)
    row = quality.table_verdict(good, "t", ["nope"], rules).first()
    assert (row["key_state"], row["grain_check"], row["overall_status"]) == ("missing_key_columns", "WARN", "WARN")
    row = quality.table_verdict(good, "t", [], rules).first()
    assert (row["key_state"], row["expected_key"], row["grain_check"]) == ("no_key", None, "WARN")


def test_submission_contract(spark):
    sample = spark.createDataFrame([(date(2023, 1, 1),), (date(2023, 1, 2),)], "Date date")

    def status(rows, ddl="Date string, Revenue double, COGS double"):
        return quality.submission_check(spark.createDataFrame(rows, ddl), sample).first()

    assert status([("2023-01-01", 1.0, 1.0), ("2023-01-02", 2.0, 1.0)])["status"] == "PASS"
    assert status([("2023-01-01", 1.0, 1.0)])["row_count_ok"] is False
    assert status([("2023-01-01", 1.0, 1.0), ("2023-01-03", 2.0, 1.0)])["dates_ok"] is False
    assert status([("2023-01-01", 1.0, None), ("2023-01-02", 2.0, 1.0)])["complete_ok"] is False
    assert status([("2023-01-01", -1.0, 1.0), ("2023-01-02", 2.0, 1.0)])["non_negative_ok"] is False
    assert status([("2023-01-01", 1.0, 1.0), ("2023-01-02", 2.0, 1.0)], "Date string, COGS double, Revenue double")["columns_ok"] is False


def test_repeated_rows_with_nulls(spark):
    rows = [(1, None), (None, 1), (1, None), (1, None), (2, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert quality.repeated_row_count(df).first()[0] == 2


def test_require_unique_names_the_table(shop):
    quality.require_unique({"orders": (shop["orders"], ["order_id"])})
    with pytest.raises(ValueError, match="orders .order_id.: 6"):
        quality.require_unique({"orders": (shop["orders"].union(shop["orders"]), ["order_id"]), "geo": (shop["geography"], ["zip"])})


def test_an_order_without_a_known_customer_shows(shop, spark):
    orders = shop["orders"].unionByName(shop["orders"].limit(1).selectExpr("99L as order_id", "order_date", "404L as customer_id", "zip", "order_status", "payment_method", "device_type", "order_source"))
    joined = joins.orders_customers(orders, shop["customers"])
    status = [c for c in joined.columns if "status" in c and c != "order_status"][0]
    assert [r["order_id"] for r in joined.where(f"{status} = 'left_only'").collect()] == [99]
