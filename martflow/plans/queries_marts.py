"""Registered queries: facts and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.functions.expr import any_present, with_line_money
from martflow.operators import marts, quality
from martflow.plans.queries_quality import item_lines
from martflow.plans.registry import Query
from martflow.sources.retail_views import RetailViews

ITEM_MEASURES = (
    "order_id:i product_id:i quantity:2 unit_price:6 discount_amount:4 promo_id promo_id_2 product_name category segment size:i "
    "price:2 cogs:3 return_records:i return_quantity:2 refund_amount:4 first_return_date:d top_return_reason review_records:i "
    "avg_rating:6 first_review_date:d line_revenue:4 line_cogs:4 gross_profit:4 gross_margin:6 has_promo is_returned"
)
ITEM_FACT = (
    ITEM_MEASURES + " order_date:d customer_id:i zip:i order_status payment_method age_group region district payment_value:2 "
    "installments:i ship_date:d delivery_date:d shipping_fee:4 order_month"
)
ORDER_LINE_FACT = (
    "order_id:i product_id:i quantity:2 unit_price:6 discount_amount:4 promo_id promo_id_2 product_name category segment size:i "
    "price:2 cogs:3 order_date:d customer_id:i zip:i order_status payment_method payment_value:2 installments:i shipping_fee:4 "
    "delivery_lead_days:i return_quantity:2 refund_amount:4 return_records:i avg_rating:6 review_records:i line_revenue:4 "
    "line_cogs:4 line_gross_profit:4 line_margin_pct:6 has_promo has_double_promo year:i month:i year_month"
)
ORDER_FACT = (
    "order_id:i order_date:d customer_id:i zip:i order_status payment_method age_group region district payment_value:2 "
    "installments:i ship_date:d delivery_date:d shipping_fee:4 order_items:i order_units:2 order_revenue_from_items:3 "
    "order_cogs_from_items:3 order_discount:3 any_promo any_return avg_order_rating:6 ship_lead_days:i delivery_lead_days:i order_month"
)
CUSTOMER_360 = (
    "customer_id:i zip:i age_group orders:i total_revenue:2 total_units:2 first_order_date:d last_order_date:d return_orders:i "
    "promo_orders:i return_order_rate:6 promo_order_rate:6"
)
PRODUCT_360 = (
    "product_id:i product_name category segment size:i price:2 cogs:3 item_lines:i units_sold:2 revenue:2 cogs_total:2 "
    "gross_profit:2 promo_lines:i returned_lines:i avg_rating:6 gross_margin:6 promo_line_rate:6 return_line_rate:6 "
    "revenue_rank:i cum_revenue_share:6 abc_class"
)
PRODUCT_MART = (
    "product_id:i product_name category segment size:i price:2 cogs:3 units_sold:2 revenue:2 orders:i promo_line_rate:6 "
    "return_units:2 unit_return_rate:6 gross_margin_pct:6 avg_stockout_days:6 stockout_months:i avg_days_of_supply:6 avg_fill_rate:6"
)
DAILY_PANEL = (
    "Date:d Revenue:2 COGS:2 sessions:i unique_visitors:i page_views:2 avg_bounce_rate:6 avg_session_duration_sec:6 orders:i "
    "order_units:2 promo_orders:i return_orders:i avg_delivery_lead_days:6 gross_profit:2 gross_margin:6 year:i month:i "
    "dayofweek:i is_weekend:i"
)
PRODUCT_MONTH = (
    "snapshot_date:d product_id:i category segment product_name units_sold:2 stock_on_hand:i stockout_days:4 days_of_supply:6 "
    "fill_rate:6 sell_through_rate:6 stockout_flag:i overstock_flag:i reorder_flag:i price:2 cogs:3 size:i item_units_sold:2 "
    "item_revenue:3 item_gross_profit:3 promo_lines:i returned_lines:i inventory_risk_score:i"
)


def order_facts(v: RetailViews, checked: bool = False):
    return marts.order_fact(
        v.orders(), item_lines(v), v.customers(), v.geography(), v.payments(), v.shipments(), checked,
        v.owners("customers", "geography", "payments", "shipments"),
    )


def order_days(v: RetailViews):
    return marts.order_days(v.orders_without_place(), item_lines(v), v.shipments())


def line_fact(v: RetailViews):
    return marts.order_line_fact(
        v.order_items(), v.orders(), v.products(), v.payments(), v.shipments(), v.returns(), v.reviews(),
        owners=v.owners("orders", "products", "payments"),
    )


def slim_line_fact(v: RetailViews, **parts):
    """Line fact with only the optional parts an answer needs."""
    return marts.order_line_fact(v.order_items(), v.orders_without_place(), v.products(), **parts, checked=False)


def dated_lines(v: RetailViews):
    return item_lines(v).join(v.orders_without_place().select("order_id", "order_date"), "order_id", "inner")


def item_facts(v: RetailViews, checked: bool = False):
    t = v.tables()
    return marts.item_fact(
        t["order_items"], t["orders"], t["products"], t["customers"], t["geography"], t["payments"],
        t["shipments"], t["returns"], t["reviews"], checked,
        v.owners("orders", "products", "customers", "geography", "payments", "shipments"),
    )


def customers_360(v: RetailViews):
    return marts.customer_360(v.customers(), marts.order_outcomes(v.orders_without_place(), item_lines(v)))


def product_months(v: RetailViews):
    return marts.product_month_panel(v.inventory(), v.products(), dated_lines(v))


def product_marts(v: RetailViews):
    lines = v.order_items().select("order_id", "product_id", "quantity", "unit_price", "promo_id", "promo_id_2")
    fact = marts.order_line_fact(lines, v.orders_without_place(), v.products(), returns=v.returns(), checked=False)
    return marts.product_mart(v.products(), fact, v.inventory())


def daily_panels(v: RetailViews):
    return marts.daily_panel(v.sales(), v.web_traffic(), order_days(v))


QUERIES: dict[str, Query] = {
    "line_money": Query(
        "order_id:i product_id:i line_revenue:4 line_cogs:4 gross_profit:4 gross_margin:6",
        lambda v: with_line_money(v.order_items().join(v.products(), "product_id", "left")),
        "select * from m_item_measures",
    ),
    "promo_flags": Query(
        "order_id:i product_id:i promo_id promo_id_2 has_promo has_double_promo any_promo",
        lambda v: slim_line_fact(v).withColumn(
            "any_promo", any_present(("promo_id", "promo_id_2"))
        ),
        """select order_id, product_id, promo_id, promo_id_2, promo_id is not null as has_promo,
                  (promo_id is not null and promo_id_2 is not null) as has_double_promo,
                  (promo_id is not null or promo_id_2 is not null) as any_promo from v_order_items""",
    ),
    "returns_agg": Query(
        "order_id:i product_id:i return_records:i return_quantity:2 refund_amount:4 first_return_date:d top_return_reason",
        lambda v: marts.returns_agg(v.returns()),
        "select * from m_returns_agg",
    ),
    "reviews_agg": Query(
        "order_id:i product_id:i review_records:i avg_rating:6 first_review_date:d",
        lambda v: marts.reviews_agg(v.reviews()),
        "select * from m_reviews_agg",
    ),
    "item_fact": Query(ITEM_FACT, lambda v: item_facts(v, checked=True), "select * from m_item_fact"),
    "order_line_fact": Query(
        ORDER_LINE_FACT,
        line_fact,
        "select * from m_order_line_fact",
    ),
    "order_fact": Query(ORDER_FACT, lambda v: order_facts(v, checked=True), "select * from m_order_fact"),
    "customer_360": Query(CUSTOMER_360, customers_360, "select * from m_customer_360"),
    "customer_mart": Query(
        "customer_id:i zip:i age_group n_orders:i first_order_date:d last_order_date:d total_revenue:2 avg_order_value:6 "
        "active_days:i orders_per_active_day:6",
        lambda v: marts.customer_mart(v.customers(), v.orders_without_place(), slim_line_fact(v)),
        """select c.*, coalesce(a.n_orders, 0) as n_orders, first_order_date, last_order_date,
                  coalesce(total_revenue, 0) as total_revenue, avg_order_value,
                  date_diff('day', first_order_date, last_order_date) + 1 as active_days,
                  a.n_orders / cast(date_diff('day', first_order_date, last_order_date) + 1 as double) as orders_per_active_day
           from v_customers c left join (
             select customer_id, count(distinct o.order_id) as n_orders, min(order_date) as first_order_date,
                    max(order_date) as last_order_date, coalesce(sum(r), 0) as total_revenue, avg(r) as avg_order_value
             from v_orders o left join (select order_id, sum(quantity * unit_price) as r from v_order_items group by order_id) x
               on o.order_id = x.order_id group by customer_id) a on c.customer_id = a.customer_id""",
    ),
    "product_360": Query(
        PRODUCT_360, lambda v: marts.product_360(v.products(), item_lines(v)), "select * from m_product_360"
    ),
    "product_mart": Query(
        PRODUCT_MART,
        product_marts,
        """select m.* from m_product_mart m""",
    ),
    "product_month_panel": Query(PRODUCT_MONTH, product_months, "select * from m_product_month"),
    "daily_traffic": Query(
        "Date:d sessions:i unique_visitors:i page_views:2 bounce_rate:6 avg_session_duration_sec:6 n_traffic_sources:i "
        "views_per_session:6 visitors_per_session:6",
        lambda v: marts.daily_traffic(v.web_traffic()),
        """select *, page_views / cast(nullif(sessions, 0) as double) as views_per_session,
                  unique_visitors / cast(nullif(sessions, 0) as double) as visitors_per_session from m_daily_traffic""",
    ),
    "daily_event_traffic": Query(
        "Date:d sessions:i unique_visitors:i page_views:i bounce_rate:6 avg_session_duration_sec:6 n_traffic_sources:i "
        "views_per_session:6 visitors_per_session:6",
        lambda v: marts.daily_traffic(v.event_traffic()),
        """select "date" as "Date", sum(sessions) as sessions, sum(unique_visitors) as unique_visitors, sum(page_views) as page_views,
                  avg(bounce_rate) as bounce_rate, avg(avg_session_duration_sec) as avg_session_duration_sec,
                  count(distinct traffic_source) as n_traffic_sources, sum(page_views) / cast(sum(sessions) as double) as views_per_session,
                  sum(unique_visitors) / cast(sum(sessions) as double) as visitors_per_session
           from v_event_traffic group by "date" """,
    ),
    "daily_orders": Query(
        "Date:d n_orders:i cancelled_orders:i cancel_rate:6",
        lambda v: marts.daily_orders(v.orders_without_place()),
        """select order_date as "Date", count(distinct order_id) as n_orders,
                  sum(case when order_status = 'cancelled' then 1 else 0 end) as cancelled_orders,
                  sum(case when order_status = 'cancelled' then 1.0 else 0.0 end) / count(distinct order_id) as cancel_rate
           from v_orders group by order_date""",
    ),
    "daily_order_facts": Query(
        "Date:d orders:i order_units:2 promo_orders:i return_orders:i avg_delivery_lead_days:6",
        lambda v: marts.daily_order_facts(order_days(v)),
        """select order_date as "Date", count(distinct order_id) as orders, coalesce(sum(order_units), 0) as order_units,
                  sum(case when any_promo then 1 else 0 end) as promo_orders, sum(case when any_return then 1 else 0 end) as return_orders,
                  avg(delivery_lead_days) as avg_delivery_lead_days from m_order_fact group by order_date""",
    ),
    "daily_panel": Query(DAILY_PANEL, daily_panels, "select * from m_daily_panel"),
    "daily_business_panel": Query(
        "Date:d Revenue:2 COGS:2 gross_profit:2 gross_margin_pct:6 sessions:i unique_visitors:i page_views:2 bounce_rate:6 "
        "avg_session_duration_sec:6 n_orders:i cancelled_orders:i cancel_rate:6 year:i month:i dayofweek:i weekofyear:i",
        lambda v: marts.daily_business_panel(v.sales(), v.web_traffic(), v.orders_without_place()),
        """select s.*, s."Revenue" - s."COGS" as gross_profit, (s."Revenue" - s."COGS") / nullif(s."Revenue", 0) as gross_margin_pct,
                  sessions, unique_visitors, page_views, bounce_rate, avg_session_duration_sec, n_orders, cancelled_orders,
                  cancelled_orders / cast(nullif(n_orders, 0) as double) as cancel_rate,
                  extract(year from s."Date") as year, extract(month from s."Date") as month, isodow(s."Date") - 1 as dayofweek,
                  week(s."Date") as weekofyear
           from v_sales s left join m_daily_traffic t on s."Date" = t."Date"
           left join (select order_date, count(distinct order_id) as n_orders,
                             sum(case when order_status = 'cancelled' then 1 else 0 end) as cancelled_orders
                      from v_orders group by order_date) o on s."Date" = o.order_date""",
    ),
    "daily_promo": Query(
        "Date:d promo_line_rate:6 promo_revenue:3 total_revenue_items:3 total_discount:3 promo_revenue_share:6",
        lambda v: marts.daily_promo_features(slim_line_fact(v)),
        """select order_date as "Date", avg(case when has_promo then 1.0 else 0.0 end) as promo_line_rate,
                  sum(case when has_promo then line_revenue else 0 end) as promo_revenue, sum(line_revenue) as total_revenue_items,
                  sum(discount_amount) as total_discount,
                  sum(case when has_promo then line_revenue else 0 end) / nullif(sum(line_revenue), 0) as promo_revenue_share
           from m_order_line_fact group by order_date""",
    ),
    "monthly_inventory": Query(
        "year_month stockout_days:2 stockout_product_rate:6 overstock_product_rate:6 reorder_product_rate:6 "
        "avg_days_of_supply:6 avg_fill_rate:6 total_units_sold_inventory:2",
        lambda v: marts.monthly_inventory_features(v.inventory()),
        """select strftime(snapshot_date, '%Y-%m') as year_month, sum(stockout_days) as stockout_days,
                  avg(stockout_flag) as stockout_product_rate, avg(overstock_flag) as overstock_product_rate,
                  avg(reorder_flag) as reorder_product_rate, avg(days_of_supply) as avg_days_of_supply, avg(fill_rate) as avg_fill_rate,
                  sum(units_sold) as total_units_sold_inventory from v_inventory group by 1""",
    ),
    "daily_inventory": Query(
        "Date:d Revenue:2 COGS:2 year_month stockout_days:2 stockout_product_rate:6 avg_fill_rate:6 total_units_sold_inventory:2",
        lambda v: marts.add_inventory_month_to_daily(v.sales(), marts.monthly_inventory_features(v.inventory())),
        """select s.*, strftime(s."Date", '%Y-%m') as year_month, stockout_days, stockout_product_rate, avg_fill_rate,
                  total_units_sold_inventory
           from v_sales s left join (
             select strftime(snapshot_date, '%Y-%m') as ym, sum(stockout_days) as stockout_days, avg(stockout_flag) as stockout_product_rate,
                    avg(fill_rate) as avg_fill_rate, sum(units_sold) as total_units_sold_inventory from v_inventory group by 1) i
           on strftime(s."Date", '%Y-%m') = i.ym""",
    ),
}
