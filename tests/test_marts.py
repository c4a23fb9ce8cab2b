from __future__ import annotations

from datetime import date

import pytest

from martflow.operators import marts
from tests.conftest import by_key


@pytest.fixture(scope="module")
def lines(shop):
    return marts.item_measures(shop["order_items"], shop["products"], shop["returns"], shop["reviews"])


@pytest.fixture(scope="module")
def orders_built(shop, lines):
    return marts.order_fact(
        shop["orders"], lines, shop["customers"], shop["geography"], shop["payments"], shop["shipments"]
    )


@pytest.fixture(scope="module")
def light(shop):
    return marts.order_line_fact(
        shop["order_items"], shop["orders"], shop["products"], shop["payments"], shop["shipments"], shop["returns"], shop["reviews"]
    )


def test_tied_return_reason_takes_the_first(shop):
    rows = by_key(marts.returns_agg(shop["returns"]), "order_id")
    assert rows[3]["top_return_reason"] == "defective"
    assert (rows[3]["return_records"], rows[3]["return_quantity"], rows[3]["refund_amount"]) == (2, 2, 18.5)
    assert rows[3]["first_return_date"] == date(2018, 1, 24)


def test_item_fact_keeps_the_line_grain(shop):
    fact = marts.item_fact(*[shop[t] for t in (
        "order_items", "orders", "products", "customers", "geography", "payments", "shipments", "returns", "reviews")])
    rows = fact.collect()
    assert len(rows) == 6
    first = [r for r in rows if r["order_id"] == 1 and r["quantity"] == 2][0]
    assert (first["line_revenue"], first["line_cogs"], first["gross_profit"], first["gross_margin"]) == (20.0, 12.0, 8.0, 0.4)
    assert (first["has_promo"], first["is_returned"], first["avg_rating"], first["review_records"]) == (True, True, 4.5, 2)
    assert (first["order_month"], first["region"], first["age_group"]) == ("2018-01", "north", "18-24")
    zero = [r for r in rows if r["order_id"] == 4][0]
    assert zero["gross_margin"] is None and zero["has_promo"] is False
    assert len(fact.columns) == 45 + 2  # the published width of the full fact


def test_order_fact(orders_built):
    rows = by_key(orders_built, "order_id")
    assert len(rows) == 6 and len(orders_built.columns) == 30
    assert (rows[1]["order_items"], rows[1]["order_units"], rows[1]["order_revenue_from_items"]) == (2, 3, 30.0)
    assert (rows[1]["any_promo"], rows[1]["any_return"], rows[1]["delivery_lead_days"]) == (True, True, 4)
    assert rows[6]["order_items"] is None and rows[6]["any_promo"] is None and rows[6]["region"] is None


def test_customer_360_keeps_customers_without_orders(shop, orders_built):
    table = marts.customer_360(shop["customers"], orders_built)
    rows = by_key(table, "customer_id")
    assert len(table.columns) == 16
    assert (rows[3]["orders"], rows[3]["total_revenue"], rows[3]["return_order_rate"]) == (0, None, None)
    assert (rows[1]["orders"], rows[1]["return_orders"], rows[1]["promo_orders"]) == (3, 2, 3)
    assert rows[1]["promo_order_rate"] == 1.0


def test_customer_mart(shop, light):
    rows = by_key(marts.customer_mart(shop["customers"], shop["orders"], light), "customer_id")
    assert (rows[1]["n_orders"], rows[1]["active_days"], rows[1]["total_revenue"]) == (3, 2, 80.0)
    assert rows[1]["orders_per_active_day"] == 1.5
    assert (rows[3]["n_orders"], rows[3]["total_revenue"], rows[3]["avg_order_value"]) == (0, 0.0, None)


def test_product_360_ranks_with_a_tie_break(shop, lines):
    table = marts.product_360(shop["products"], lines)
    rows = by_key(table, "product_id")
    assert len(table.columns) == 22
    assert [rows[i]["revenue"] for i in (1, 2, 3, 4)] == [60.0, 20.0, 20.0, 0.0]
    assert [rows[i]["revenue_rank"] for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert [rows[i]["abc_class"] for i in (1, 2, 3, 4)] == ["A", "A", "C", "C"]  # 80 % exactly is still A
    assert (rows[4]["item_lines"], rows[4]["gross_margin"], rows[4]["promo_line_rate"]) == (0, None, None)


def test_product_mart(shop, light):
    rows = by_key(marts.product_mart(shop["products"], light, shop["inventory"]), "product_id")
    assert (rows[1]["units_sold"], rows[1]["orders"], rows[1]["unit_return_rate"]) == (6.0, 2, 4 / 6)
    assert rows[3]["gross_margin_pct"] is None  # price 0
    assert (rows[4]["units_sold"], rows[4]["avg_fill_rate"], rows[4]["unit_return_rate"]) == (0.0, None, 0.0)


def test_line_fact_counts_the_first_promotion_only(light):
    rows = {(r["order_id"], r["quantity"]): r for r in light.collect()}
    assert rows[2, 1]["has_promo"] is False and rows[2, 1]["has_double_promo"] is False
    assert rows[3, 3]["has_double_promo"] is True
    assert rows[1, 2]["delivery_lead_days"] == 3  # from shipping, not from the order
    assert rows[4, 1]["line_margin_pct"] is None


def test_line_fact_without_optional_parts(shop):
    fact = marts.order_line_fact(shop["order_items"].drop("promo_id", "promo_id_2"), shop["orders"], shop["products"].drop("cogs"))
    assert "line_cogs" not in fact.columns and "payment_value" not in fact.columns
    assert {r["has_promo"] for r in fact.collect()} == {False}


def test_duplicate_orders_break_the_fact(shop):
    twice = shop["orders"].union(shop["orders"])
    with pytest.raises(Exception, match="not unique"):
        marts.order_line_fact(shop["order_items"], twice, shop["products"]).collect()


def test_product_month_panel(shop, lines):
    dated = lines.join(shop["orders"].select("order_id", "order_date"), "order_id")
    table = marts.product_month_panel(shop["inventory"], shop["products"], dated)
    rows = by_key(table, "product_id")
    assert len(table.columns) == 16 + 4 + 5 + 1
    assert (rows[1]["item_units_sold"], rows[1]["item_revenue"], rows[1]["promo_lines"], rows[1]["returned_lines"]) == (6.0, 60.0, 2, 3)
    assert rows[1]["inventory_risk_score"] == 2 and rows[3]["inventory_risk_score"] == -1


def test_daily_tables(spark, shop, orders_built):
    sales = spark.createDataFrame([(date(2018, 1, 10), 50.0, 30.0), (date(2018, 1, 13), 0.0, 1.0)], "Date date, Revenue double, COGS double")
    panel = by_key(marts.daily_panel(sales, shop["web_traffic"], orders_built), "Date")
    row = panel[date(2018, 1, 10)]
    assert (row["sessions"], row["avg_bounce_rate"], row["orders"], row["promo_orders"]) == (100, 0.6, 2, 2)
    assert (row["gross_margin"], row["dayofweek"], row["is_weekend"]) == (0.4, 2, 0)
    empty = panel[date(2018, 1, 13)]
    assert (empty["gross_margin"], empty["orders"], empty["is_weekend"]) == (None, None, 1)
    assert len(marts.daily_panel(sales, shop["web_traffic"], orders_built).columns) == 19
    traffic = by_key(marts.daily_traffic(shop["web_traffic"]), "Date")
    assert traffic[date(2019, 5, 2)]["views_per_session"] is None
    assert traffic[date(2018, 1, 10)]["n_traffic_sources"] == 2
    slim = marts.daily_business_panel(sales)
    assert "sessions" not in slim.columns and "n_orders" not in slim.columns
    cancelled = by_key(marts.daily_orders(shop["orders"]), "Date")[date(2019, 2, 1)]
    assert (cancelled["n_orders"], cancelled["cancelled_orders"], cancelled["cancel_rate"]) == (1, 1, 1.0)


def test_daily_promo_and_monthly_inventory(shop, light):
    row = by_key(marts.daily_promo_features(light), "Date")[date(2018, 1, 10)]
    assert (row["promo_revenue"], row["total_revenue_items"], row["promo_revenue_share"]) == (20.0, 50.0, 0.4)
    month = by_key(marts.monthly_inventory_features(shop["inventory"]), "year_month")["2018-01"]
    assert (month["stockout_days"], month["stockout_product_rate"], month["total_units_sold_inventory"]) == (3, 1.0, 6)
