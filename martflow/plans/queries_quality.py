"""Registered queries: loaders, data quality and checked joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators import joins, marts, quality
from martflow.plans.registry import Query
from martflow.sources import raw
from martflow.sources.retail_views import RetailViews
from martflow.sources.schema import CANDIDATE_ITEM_KEYS, CARDINALITY_KEYS, DATE_COLUMNS, NULL_RULES, PRIMARY_KEYS, RELATIONS

# Columns of the retail tables as the views define them (name -> Spark type), for the oracle text.
TABLE_COLUMNS = {
    "products": "product_id:bigint product_name:string category:string segment:string size:int price:double cogs:double",
    "customers": "customer_id:bigint zip:int age_group:string",
    "geography": "zip:int district:string region:string",
    "orders": "order_id:bigint order_date:date customer_id:bigint zip:int order_status:string payment_method:string",
    "order_items": "order_id:bigint product_id:bigint quantity:double unit_price:double discount_amount:double "
    "promo_id:string promo_id_2:string",
    "payments": "order_id:bigint payment_value:double installments:int",
    "shipments": "order_id:bigint ship_date:date delivery_date:date shipping_fee:double",
    "returns": "return_id:bigint order_id:bigint product_id:bigint return_date:date return_reason:string "
    "return_quantity:double refund_amount:double",
    "reviews": "review_id:bigint order_id:bigint product_id:bigint customer_id:bigint review_date:date rating:int",
    "sales": "Date:date Revenue:double COGS:double",
    "inventory": "snapshot_date:date product_id:bigint category:string segment:string product_name:string "
    "units_sold:double stock_on_hand:int stockout_days:double days_of_supply:double fill_rate:double "
    "sell_through_rate:double stockout_flag:int overstock_flag:int reorder_flag:int",
    "web_traffic": "date:date traffic_source:string sessions:bigint unique_visitors:bigint page_views:double "
    "bounce_rate:double avg_session_duration_sec:double",
}

ITEM = " order_id product_id quantity unit_price discount_amount promo_id promo_id_2 "
JOINED_COLUMNS = {
    "orders_customers": "order_id order_date customer_id zip order_status payment_method zip_customer age_group "
    "customer_join_status",
    "orders_payments": "order_id order_date customer_id zip order_status payment_method payment_value installments "
    "payment_join_status",
    "orders_geography": "order_id order_date customer_id zip order_status payment_method district region geo_join_status",
    "orders_shipments": "order_id order_date customer_id zip order_status payment_method ship_date delivery_date "
    "shipping_fee shipment_join_status ship_lead_days delivery_lead_days",
    "items_orders": ITEM + "order_date customer_id zip order_status payment_method order_join_status",
    "items_products": ITEM + "product_name category segment size price cogs product_join_status",
}


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in TABLE_COLUMNS[table].split()]


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


# Columns of the views that are sums or means of doubles.
SETTLED = {"shipments": ("shipping_fee",), "sales": ("Revenue", "COGS"), "web_traffic": ("bounce_rate", "avg_session_duration_sec")}


def _settled_sql(table: str, column: str) -> str:
    return f'round("{column}", 6)' if column in SETTLED.get(table, ()) else f'"{column}"'


def _null_sql(tables) -> str:
    return _union(
        [
            f"""select '{t}' as "table", '{c}' as "column", '{kind}' as dtype, count(*) as n_rows,
                count(*) - count("{c}") as null_count, count(distinct {_settled_sql(t, c)}) as n_unique from v_{t}"""
            for t in tables
            for c, kind in _columns(t)
        ]
    )


def _duplicates_sql(source: str, keys) -> str:
    k = _quoted(keys)
    return f"select coalesce(sum(n - 1), 0) as dup, coalesce(sum(n), 0) as n_rows, count(*) as distinct_keys from (select {k}, count(*) as n from {source} group by {k}) g"


def _has_null(keys) -> str:
    return " or ".join(f'"{k}" is null' for k in keys)


def _key_profile_sql(table: str, keys, unique: bool) -> str:
    good = "nulls = 0 and dup = 0" if unique else "nulls = 0"
    return f"""select '{table}' as "table", '{", ".join(keys)}' as key_cols, n_rows as "rows", distinct_keys,
        dup as duplicate_key_rows, nulls as null_key_rows, {str(unique).lower()} as expected_unique,
        case when {good} then 'PASS' else 'CHECK' end as status
        from ({_duplicates_sql("v_" + table, keys)}) d
        cross join (select count(*) as nulls from v_{table} where {_has_null(keys)}) z"""


def _coverage_sql(child: str, parent: str, key: str) -> str:
    return f"""select '{key}' as child_key, '{key}' as parent_key, n as child_non_null_rows, missing as missing_fk_rows,
        1 - missing / cast(n as double) as coverage_rate, case when missing = 0 then 'PASS' else 'WARN' end as status,
        '{child}' as child_table, '{parent}' as parent_table
        from (select count(*) as n, sum(case when "{key}" in (select "{key}" from v_{parent}) then 0 else 1 end) as missing
              from v_{child} where "{key}" is not null) t"""


def _growth_sql(name: str, left: str, right: str, key: str, expected: str) -> str:
    return f"""select '{name}' as join_name, l as left_rows, r as right_rows, o as output_rows, o / cast(l as double) as growth_vs_left,
        '{key}' as left_key, '{key}' as right_key, '{expected}' as expected,
        case when o / cast(l as double) <= 1.05 then 'PASS' else 'CHECK' end as status, '' as note
        from (select count(*) as l from v_{left}) a cross join (select count(*) as r from v_{right}) b
        cross join (select count(*) as o from v_{left} x left join v_{right} y on x."{key}" = y."{key}") c"""


def _overview_sql(table: str) -> str:
    names = [c for c, _ in _columns(table)]
    nulls = " + ".join(f'(count(*) - count("{c}"))' for c in names)
    return f"""select '{table}' as "table", n_rows as "rows", {len(names)} as cols, nulls as total_null_values,
        round(nulls * 100.0 / (n_rows * {len(names)}), 2) as null_density_pct, dup as duplicate_rows,
        round(dup * 100.0 / n_rows, 4) as duplicate_row_pct
        from (select count(*) as n_rows, {nulls} as nulls from v_{table}) a
        cross join (select coalesce(sum(n - 1), 0) as dup from (select count(*) as n from v_{table} group by {_quoted(names)}) g) b"""


def settled_tables(v: RetailViews) -> dict[str, DataFrame]:
    """All tables; sums of doubles rounded, since their last digits depend on the order of addition."""
    tables = v.tables()
    return {n: df.withColumns({c: F.round(c, 6) for c in SETTLED.get(n, ())}) for n, df in tables.items()}


QUERIES: dict[str, Query] = {
    "order_level": Query(
        "order_id:i order_date:d customer_id:i order_status payment_method zip:i payment_value:2",
        lambda v: raw.order_level(v.orders(), v.payments()),
        "select * from v_order_level",
    ),
    "item_level": Query(
        "order_id:i product_id:i quantity:2 unit_price:6 discount_amount:4 customer_id:i order_date:d order_status category "
        "gross_merch_value:4 net_item_revenue:4 item_cogs:4 gross_profit:4 promo_used_flag:i",
        lambda v: raw.item_level(v.order_items(), v.orders_without_place(), v.products()),
        "select * from v_item_level",
    ),
    "sales_by_date": Query(
        "date:d Revenue:2 COGS:2", lambda v: raw.sales_by_date(v.sales()), 'select "Date" as date, "Revenue", "COGS" from v_sales'
    ),
    "null_report": Query(
        "table column null_count:i null_rate:6",
        lambda v: quality.null_report(v.tables()),
        f'select "table", "column", null_count, null_count / cast(n_rows as double) as null_rate from ({_null_sql(TABLE_COLUMNS)}) x where null_count > 0',
    ),
    "null_profile": Query(
        "table column dtype null_count:i null_pct:2 n_unique:i",
        lambda v: quality.null_profile(settled_tables(v)),
        f"select *, round(null_count * 100.0 / n_rows, 2) as null_pct from ({_null_sql(TABLE_COLUMNS)}) x",
    ),
    "duplicate_keys": Query(
        "table keys status duplicate_rows:i",
        lambda v: quality.duplicate_key_report(v.tables()),
        _union(
            [
                f"""select '{t}' as "table", '{",".join(k)}' as keys, case when dup = 0 then 'PASS' else 'FAIL' end as status,
                    dup as duplicate_rows from ({_duplicates_sql("v_" + t, k)}) d"""
                for t, k in PRIMARY_KEYS.items()
                if t in TABLE_COLUMNS
            ]
        ),
    ),
    "key_profile": Query(
        "table key_cols rows:i distinct_keys:i duplicate_key_rows:i null_key_rows:i expected_unique status",
        lambda v: quality.cardinality_checks(v.tables()),
        _union([_key_profile_sql(t, k, u) for t, k, u in CARDINALITY_KEYS if t in TABLE_COLUMNS]),
    ),
    "candidate_keys": Query(
        "candidate_key duplicate_rows:i",
        lambda v: quality.candidate_keys(v.order_items()),
        _union(
            [
                f"select '{', '.join(k)}' as candidate_key, dup as duplicate_rows from ({_duplicates_sql('v_order_items', k)}) d"
                for k in CANDIDATE_ITEM_KEYS
            ]
        ),
    ),
    "duplicate_groups": Query(
        "order_id:i product_id:i n_rows:i",
        lambda v: quality.duplicate_groups(v.order_items(), ["order_id", "product_id"]),
        "select order_id, product_id, count(*) as n_rows from v_order_items group by order_id, product_id having count(*) > 1",
    ),
    "duplicate_rows": Query(
        "order_id:i product_id:i quantity:2 unit_price:6 discount_amount:4 promo_id promo_id_2 n_rows:i",
        lambda v: quality.duplicate_rows(v.order_items(), ["order_id", "product_id"]),
        "select * from (select *, count(*) over (partition by order_id, product_id) as n_rows from v_order_items) t where n_rows > 1",
    ),
    "fk_coverage": Query(
        "child_key parent_key child_non_null_rows:i missing_fk_rows:i coverage_rate:6 status child_table parent_table",
        lambda v: quality.relationship_report(v.tables()),
        _union([_coverage_sql(*r) for r in RELATIONS]),
    ),
    "date_ranges": Query(
        "table date_col min_date:d max_date:d null_dates:i rows:i",
        lambda v: quality.date_range_report(v.tables()),
        _union(
            [
                f"""select '{t}' as "table", '{c}' as date_col, min("{c}") as min_date, max("{c}") as max_date,
                    count(*) - count("{c}") as null_dates, count(*) as "rows" from v_{t}"""
                for t, cs in DATE_COLUMNS.items()
                if t in TABLE_COLUMNS
                for c in cs
                if c in [n for n, _ in _columns(t)]
            ]
        ),
    ),
    "no_future_dates": Query(
        "no_future_dates",
        lambda v: quality.no_future_dates(v.orders_without_place(), "order_date", "2001-07-31"),
        "select bool_and(coalesce(order_date <= date '2001-07-31', false)) as no_future_dates from v_orders",
    ),
    "order_payment_recon": Query(
        "orders:i payments:i orders_without_payment:i payments_without_order:i status",
        lambda v: quality.order_payment_reconciliation(v.orders_without_place(), v.payments()),
        """select *, case when orders_without_payment = 0 and payments_without_order = 0 then 'PASS' else 'WARN' end as status from
           (select (select count(distinct order_id) from v_orders) as orders, (select count(distinct order_id) from v_payments) as payments,
             (select count(*) from (select order_id from v_orders except select order_id from v_payments) a) as orders_without_payment,
             (select count(*) from (select order_id from v_payments except select order_id from v_orders) b) as payments_without_order) t""",
    ),
    "product_margin_rule": Query(
        "product_id:i price:2 cogs:3 gross_margin_pct:6 rule_cogs_lt_price",
        lambda v: quality.product_margin_rule(v.products()),
        "select product_id, price, cogs, (price - cogs) / nullif(price, 0) as gross_margin_pct, cogs < price as rule_cogs_lt_price from v_products",
    ),
    "shipment_status_rule": Query(
        "order_id:i order_status allowed_status",
        lambda v: quality.shipment_status_rule(v.orders_without_place(), v.shipments()),
        """select s.order_id, o.order_status, coalesce(o.order_status in ('shipped', 'delivered', 'returned'), false) as allowed_status
           from (select distinct order_id from v_shipments) s left join v_orders o on s.order_id = o.order_id""",
    ),
    "shipment_violations": Query(
        "missing_shipment:i unexpected_shipment:i",
        lambda v: quality.shipment_violations(joins.orders_shipments(v.orders_without_place(), v.shipments(), v.owners("payments"))),
        """select sum(case when needs and not has then 1 else 0 end) as missing_shipment,
                  sum(case when not needs and has then 1 else 0 end) as unexpected_shipment
           from (select order_status in ('shipped', 'delivered', 'returned') as needs,
                        ship_date is not null or delivery_date is not null or shipping_fee is not null as has
                 from m_orders_shipments) t""",
    ),
    "table_shapes": Query(
        "table rows:i cols:i",
        lambda v: quality.table_shapes(v.tables()),
        _union(
            [f"""select '{t}' as "table", count(*) as "rows", {len(_columns(t))} as cols from v_{t}""" for t in TABLE_COLUMNS]
        ),
    ),
    "audit_overview": Query(
        "table rows:i cols:i total_null_values:i null_density_pct:2 duplicate_rows:i duplicate_row_pct:4",
        lambda v: quality.audit_overview(v.tables()),
        _union([_overview_sql(t) for t in TABLE_COLUMNS]),
    ),
    "missing_payment_rows": Query(
        "order_id:i order_status payment_method payment_value:2 installments:i",
        lambda v: quality.missing_payment_rows(joins.orders_payments(v.orders(), v.payments())),
        """select o.order_id, o.order_status, o.payment_method, p.payment_value, p.installments from v_orders o
           left join v_payments p on o.order_id = p.order_id
           where o.payment_method is null or p.payment_value is null or p.installments is null""",
    ),
    "missing_shipment_rows": Query(
        "order_id:i order_status ship_date:d delivery_date:d shipping_fee:4",
        lambda v: quality.missing_shipment_rows(joins.orders_shipments(v.orders_without_place(), v.shipments(), v.owners("payments"))),
        """select order_id, order_status, ship_date, delivery_date, shipping_fee from m_orders_shipments
           where ship_date is null or delivery_date is null or shipping_fee is null""",
    ),
    "join_log": Query(
        "join_name left_rows:i right_rows:i output_rows:i growth_vs_left:6 left_key right_key expected status note",
        lambda v: joins.join_log(v.tables()),
        _union(
            [
                _growth_sql("orders_payments", "orders", "payments", "order_id", "1:1"),
                _growth_sql("items_orders", "order_items", "orders", "order_id", "m:1"),
                _growth_sql("items_products", "order_items", "products", "product_id", "m:1"),
                _growth_sql("orders_customers", "orders", "customers", "customer_id", "m:1"),
                _growth_sql("orders_geography", "orders", "geography", "zip", "m:1"),
                _growth_sql("orders_shipments", "orders", "shipments", "order_id", "1:0/1"),
            ]
        ),
    ),
    "orders_payments": Query(
        "order_id:i order_date:d customer_id:i zip:i order_status payment_method payment_value:2 installments:i payment_join_status",
        lambda v: joins.orders_payments(v.orders(), v.payments()),
        "select * from m_orders_payments",
    ),
    "items_orders": Query(
        "order_id:i product_id:i quantity:2 unit_price:6 discount_amount:4 promo_id promo_id_2 order_date:d customer_id:i zip:i "
        "order_status payment_method order_join_status",
        lambda v: joins.items_orders(v.order_items(), v.orders(), v.owners("orders")),
        "select * from m_items_orders",
    ),
    "items_products": Query(
        "order_id:i product_id:i quantity:2 unit_price:6 product_name category segment size:i price:2 cogs:3 product_join_status",
        lambda v: joins.items_products(v.order_items(), v.products(), v.owners("products")),
        "select * from m_items_products",
    ),
    "orders_customers": Query(
        "order_id:i order_date:d customer_id:i zip:i order_status payment_method zip_customer:i age_group customer_join_status",
        lambda v: joins.orders_customers(v.orders(), v.customers(), v.owners("customers")),
        "select * from m_orders_customers",
    ),
    "orders_geography": Query(
        "order_id:i order_date:d customer_id:i zip:i order_status payment_method district region geo_join_status",
        lambda v: joins.orders_geography(v.orders(), v.geography(), v.owners("geography")),
        "select * from m_orders_geography",
    ),
    "orders_shipments": Query(
        "order_id:i order_date:d customer_id:i zip:i order_status payment_method ship_date:d delivery_date:d shipping_fee:4 "
        "shipment_join_status ship_lead_days:i delivery_lead_days:i",
        lambda v: joins.orders_shipments(v.orders(), v.shipments(), v.owners("orders", "shipments")),
        "select * from m_orders_shipments",
    ),
}

# Names used by other query modules.
line_tables = ("order_items", "products", "returns", "reviews")


def item_lines(v: RetailViews):
    """Lines for tables and answers built on them; the fact queries are the ones that check keys."""
    return marts.item_measures(*[getattr(v, t)() for t in line_tables], checked=False)
