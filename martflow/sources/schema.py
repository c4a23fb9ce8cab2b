"""Declared columns, keys, relations and null rules of the retail tables.

Types are DDL strings. The CSV reader casts by name, so a file may carry extra columns
(they stay strings) or lack optional ones.
"""

from __future__ import annotations

# Raw tables, their columns and types.
RAW_TABLES: dict[str, dict[str, str]] = {
    "products": {
        "product_id": "bigint", "product_name": "string", "category": "string", "segment": "string",
        "size": "string", "color": "string", "price": "double", "cogs": "double",
    },
    "customers": {
        "customer_id": "bigint", "zip": "bigint", "city": "string", "signup_date": "date",
        "gender": "string", "age_group": "string", "acquisition_channel": "string",
    },
    "promotions": {
        "promo_id": "string", "start_date": "date", "end_date": "date", "applicable_category": "string",
    },
    "geography": {"zip": "bigint", "city": "string", "region": "string", "district": "string"},
    "orders": {
        "order_id": "bigint", "order_date": "date", "customer_id": "bigint", "zip": "bigint",
        "order_status": "string", "payment_method": "string", "device_type": "string",
        "order_source": "string",
    },
    "order_items": {
        "order_id": "bigint", "product_id": "bigint", "quantity": "int", "unit_price": "double",
        "discount_amount": "double", "promo_id": "string", "promo_id_2": "string",
    },
    "payments": {
        "order_id": "bigint", "payment_method": "string", "payment_value": "double", "installments": "int",
    },
    "shipments": {
        "order_id": "bigint", "ship_date": "date", "delivery_date": "date", "shipping_fee": "double",
    },
    "returns": {
        "return_id": "string", "order_id": "bigint", "product_id": "bigint", "return_date": "date",
        "return_reason": "string", "return_quantity": "int", "refund_amount": "double",
    },
    "reviews": {
        "review_id": "string", "order_id": "bigint", "product_id": "bigint", "customer_id": "bigint",
        "review_date": "date", "rating": "int", "review_title": "string",
    },
    "sales": {"Date": "date", "Revenue": "double", "COGS": "double"},
    "sample_submission": {"Date": "date", "Revenue": "double", "COGS": "double"},
    "inventory": {
        "snapshot_date": "date", "product_id": "bigint", "product_name": "string", "category": "string",
        "segment": "string", "stock_on_hand": "int", "units_sold": "int", "stockout_days": "int",
        "days_of_supply": "double", "fill_rate": "double", "sell_through_rate": "double",
        "stockout_flag": "int", "overstock_flag": "int", "reorder_flag": "int", "year": "int", "month": "int",
    },
    "web_traffic": {
        "date": "date", "traffic_source": "string", "sessions": "bigint", "unique_visitors": "bigint",
        "page_views": "bigint", "bounce_rate": "double", "avg_session_duration_sec": "double",
    },
}

# Declared date columns per table.
DATE_COLUMNS: dict[str, list[str]] = {
    "orders": ["order_date"],
    "customers": ["signup_date"],
    "promotions": ["start_date", "end_date"],
    "shipments": ["ship_date", "delivery_date"],
    "returns": ["return_date"],
    "reviews": ["review_date"],
    "sales": ["Date"],
    "sample_submission": ["Date"],
    "inventory": ["snapshot_date"],
    "web_traffic": ["date"],
}

# Primary keys used by the duplicate-key report.
PRIMARY_KEYS: dict[str, list[str]] = {
    "products": ["product_id"],
    "customers": ["customer_id"],
    "promotions": ["promo_id"],
    "geography": ["zip"],
    "orders": ["order_id"],
    "payments": ["order_id"],
    "returns": ["return_id"],
    "reviews": ["review_id"],
}

# Fixed values: (table, key columns, key expected to be unique) for the cardinality check.
CARDINALITY_KEYS: list[tuple[str, list[str], bool]] = [
    ("products", ["product_id"], True),
    ("customers", ["customer_id"], True),
    ("promotions", ["promo_id"], True),
    ("geography", ["zip"], True),
    ("orders", ["order_id"], True),
    ("order_items", ["order_id", "product_id"], False),
    ("payments", ["order_id"], True),
    ("shipments", ["order_id"], True),
    ("returns", ["return_id"], True),
    ("reviews", ["review_id"], True),
    ("sales", ["Date"], True),
    ("inventory", ["snapshot_date", "product_id"], True),
    ("web_traffic", ["date", "traffic_source"], True),
]

# Fixed values: (child table, parent table, key) relations for the foreign-key report.
RELATIONS: list[tuple[str, str, str]] = [
    ("orders", "customers", "customer_id"),
    ("orders", "geography", "zip"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("payments", "orders", "order_id"),
    ("shipments", "orders", "order_id"),
    ("returns", "orders", "order_id"),
    ("returns", "products", "product_id"),
    ("reviews", "orders", "order_id"),
    ("reviews", "products", "product_id"),
    ("reviews", "customers", "customer_id"),
    ("inventory", "products", "product_id"),
]

# Expected grain of every built table.
EXPECTED_GRAIN: dict[str, list[str]] = {
    "orders_customers": ["order_id"],
    "orders_payments": ["order_id"],
    "orders_geography": ["order_id"],
    "orders_shipments": ["order_id"],
    "items_orders": ["order_id", "product_id", "unit_price"],
    "items_products": ["order_id", "product_id", "unit_price"],
    "items_returns": ["order_id", "product_id", "unit_price"],
    "items_reviews": ["order_id", "product_id", "unit_price"],
    "items_double_promotions": ["order_id", "product_id", "unit_price"],
    "item_fact": ["order_id", "product_id", "unit_price"],
    "order_fact": ["order_id"],
    "customer_360": ["customer_id"],
    "product_360": ["product_id"],
    "daily_panel": ["Date"],
    "product_month_panel": ["product_id", "year", "month"],
}

# Key and expected uniqueness of every written mart.
MART_KEYS: dict[str, tuple[list[str], bool]] = {
    "item_fact": (["order_id", "product_id"], False),
    "order_fact": (["order_id"], True),
    "customer_360": (["customer_id"], True),
    "product_360": (["product_id"], True),
    "daily_panel": (["Date"], True),
    "product_month_panel": (["snapshot_date", "product_id"], True),
}

# Which columns may be null, per built table. "structural" nulls come from the
# data model, "expected" ones from optional profile fields, "unexpected" ones are defects.
NULL_RULES: dict[str, dict[str, list[str]]] = {
    "orders_customers": {
        "expected": ["gender", "age_group", "acquisition_channel"],
        "unexpected": ["order_id", "customer_id", "order_date", "zip"],
    },
    "orders_payments": {"unexpected": ["order_id", "payment_method", "payment_value", "installments"]},
    "orders_geography": {"unexpected": ["order_id", "zip", "city", "region", "district"]},
    "orders_shipments": {
        "structural": ["ship_date", "delivery_date", "shipping_fee"],
        "unexpected": ["order_id", "order_status"],
    },
    "items_orders": {"unexpected": ["order_id", "product_id", "quantity", "unit_price"]},
    "items_products": {
        "unexpected": ["order_id", "product_id", "product_name", "category", "segment", "price", "cogs"],
    },
    "items_returns": {
        "structural": ["return_id", "return_date", "return_reason", "return_quantity", "refund_amount"],
        "unexpected": ["order_id", "product_id"],
    },
    "items_reviews": {
        "structural": ["review_id", "review_date", "rating", "review_title"],
        "unexpected": ["order_id", "product_id"],
    },
    "items_double_promotions": {
        "structural": ["promo_id", "promo_id_2"],
        "unexpected": ["order_id", "product_id"],
    },
    "item_fact": {
        "structural": ["promo_id", "promo_id_2", "return_id", "review_id", "rating"],
        "expected": ["gender", "age_group", "acquisition_channel"],
        "unexpected": ["order_id", "product_id", "quantity", "unit_price"],
    },
    "order_fact": {
        "structural": ["ship_date", "delivery_date", "shipping_fee"],
        "expected": ["gender", "age_group", "acquisition_channel"],
        "unexpected": ["order_id", "customer_id", "order_date"],
    },
    "customer_360": {
        "expected": ["gender", "age_group", "acquisition_channel"],
        "unexpected": ["customer_id"],
    },
    "product_360": {
        "unexpected": ["product_id", "product_name", "category", "segment", "price", "cogs"],
    },
    "daily_panel": {"unexpected": ["Date"]},
    "product_month_panel": {"unexpected": ["product_id", "year", "month"]},
}

# Key sets tried when looking for the grain of the order lines.
CANDIDATE_ITEM_KEYS: list[list[str]] = [
    ["order_id", "product_id"],
    ["order_id", "product_id", "unit_price"],
    ["order_id", "product_id", "unit_price", "discount_amount"],
    ["order_id", "product_id", "promo_id", "promo_id_2"],
    ["order_id", "product_id", "quantity", "unit_price", "discount_amount", "promo_id", "promo_id_2"],
]

# The (table, grain, key, base table, joined tables, meaning) dictionary.
DATA_DICTIONARY: list[tuple[str, str, str, str, str, str]] = [
    ("orders_customers", "one row per order", "order_id", "orders", "customers", "order with customer profile"),
    ("orders_payments", "one row per order", "order_id", "orders", "payments", "order with payment"),
    ("orders_geography", "one row per order", "order_id", "orders", "geography", "order with place"),
    ("orders_shipments", "one row per order", "order_id", "orders", "shipments", "order with shipment dates"),
    ("items_orders", "one row per order line", "order_id, product_id, unit_price", "order_items", "orders",
     "order line with order context"),
    ("items_products", "one row per order line", "order_id, product_id, unit_price", "order_items", "products",
     "order line with product context"),
    ("items_returns", "one row per order line", "order_id, product_id, unit_price", "order_items", "returns",
     "order line with its returns"),
    ("items_reviews", "one row per order line", "order_id, product_id, unit_price", "order_items", "reviews",
     "order line with its reviews"),
    ("items_double_promotions", "one row per order line", "order_id, product_id, unit_price", "order_items", "promotions",
     "order line under two promotions"),
    ("item_fact", "one row per order line", "order_id, product_id, unit_price", "order_items",
     "orders, products, customers, geography, payments, shipments, returns, reviews", "full order-line fact"),
    ("order_fact", "one row per order", "order_id", "orders",
     "order_items, payments, shipments, customers, geography", "order fact"),
    ("customer_360", "one row per customer", "customer_id", "customers", "order_fact", "customer summary"),
    ("product_360", "one row per product", "product_id", "products", "item_fact", "product summary"),
    ("daily_panel", "one row per day", "Date", "sales", "web_traffic, order_fact", "daily business panel"),
    ("product_month_panel", "one row per product and month", "product_id, year, month", "inventory",
     "products, item_fact", "monthly stock and sales of a product"),
]
