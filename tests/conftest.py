from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martflow.session import build_session  # noqa: E402

SF_SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "martflow-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.files.maxPartitionBytes": "16MB",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def many_chunks(spark):
    """Eight fixed shuffle partitions, so that range cuts really happen on small frames."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="session")
def shop(spark):
    """A tiny shop with the awkward rows: repeated lines, empty orders, unsold products, ties."""
    rows = {
        "products": (
            "product_id bigint, product_name string, category string, segment string, size string, color string, price double, cogs double",
            [
                (1, "tee", "tops", "casual", "M", "red", 10.0, 6.0),
                (2, "cap", "hats", "casual", "S", "blue", 20.0, 25.0),
                (3, "sock", "feet", "sport", "L", None, 0.0, 1.0),
                (4, "belt", "feet", "sport", "L", "black", 8.0, 8.0),
            ],
        ),
        "customers": (
            "customer_id bigint, zip bigint, city string, signup_date date, gender string, age_group string, acquisition_channel string",
            [
                (1, 100, "A", date(2018, 1, 1), "f", "18-24", "ads"),
                (2, 100, "A", date(2018, 1, 2), None, "25-34", "ads"),
                (3, 200, "B", date(2018, 1, 3), "m", None, "mail"),
            ],
        ),
        "geography": (
            "zip bigint, city string, region string, district string",
            [(100, "A", "north", "d1"), (200, "B", "south", "d2")],
        ),
        "orders": (
            "order_id bigint, order_date date, customer_id bigint, zip bigint, order_status string, payment_method string, device_type string, order_source string",
            [
                (1, date(2018, 1, 10), 1, 100, "delivered", "card", "web", "ads"),
                (2, date(2018, 1, 10), 1, 100, "delivered", "card", "web", "ads"),
                (3, date(2018, 1, 11), 1, 100, "returned", "cod", "app", "mail"),
                (4, date(2019, 2, 1), 2, 100, "cancelled", "cod", "app", "mail"),
                (5, date(2019, 5, 2), 2, 100, "shipped", "card", "app", "mail"),
                (6, date(2019, 8, 1), 2, 999, "delivered", "card", "app", "mail"),
            ],
        ),
        "order_items": (
            "order_id bigint, product_id bigint, quantity int, unit_price double, discount_amount double, promo_id string, promo_id_2 string",
            [
                (1, 1, 2, 10.0, 1.0, "P1", None),
                (1, 1, 1, 10.0, 0.0, None, None),
                (2, 2, 1, 20.0, 0.0, None, "P2"),
                (3, 1, 3, 10.0, 5.0, "P1", "P2"),
                (4, 2, 1, 0.0, 0.0, None, None),
                (5, 3, 4, 5.0, 30.0, None, None),
            ],
        ),
        "payments": (
            "order_id bigint, payment_method string, payment_value double, installments int",
            [(1, "card", 29.0, 1), (2, "card", 20.0, 2), (3, "cod", 25.0, 1), (4, "cod", None, 1), (5, "card", 0.0, 3)],
        ),
        "shipments": (
            "order_id bigint, ship_date date, delivery_date date, shipping_fee double",
            [
                (1, date(2018, 1, 11), date(2018, 1, 14), 2.0),
                (2, date(2018, 1, 10), date(2018, 1, 10), 2.5),
                (3, date(2018, 1, 12), date(2018, 1, 20), 3.0),
                (4, date(2019, 2, 2), date(2019, 2, 4), 1.0),
            ],
        ),
        "returns": (
            "return_id string, order_id bigint, product_id bigint, return_date date, return_reason string, return_quantity int, refund_amount double",
            [
                ("r1", 3, 1, date(2018, 1, 25), "wrong_size", 1, 9.0),
                ("r2", 3, 1, date(2018, 1, 24), "defective", 1, 9.5),
                ("r3", 1, 1, date(2018, 1, 20), "defective", 1, 9.0),
            ],
        ),
        "reviews": (
            "review_id string, order_id bigint, product_id bigint, customer_id bigint, review_date date, rating int, review_title string",
            [("v1", 1, 1, 1, date(2018, 1, 21), 4, "ok"), ("v2", 1, 1, 1, date(2018, 1, 22), 5, "good"), ("v3", 2, 2, 1, date(2018, 2, 1), 1, None)],
        ),
        "inventory": (
            "snapshot_date date, product_id bigint, product_name string, category string, segment string, stock_on_hand int, units_sold int, "
            "stockout_days int, days_of_supply double, fill_rate double, sell_through_rate double, stockout_flag int, overstock_flag int, reorder_flag int, year int, month int",
            [
                (date(2018, 1, 31), 1, "tee", "tops", "casual", 5, 6, 3, 10.0, 0.9, 0.6, 1, 0, 1, 2018, 1),
                (date(2019, 5, 31), 3, "sock", "feet", "sport", 50, 4, 0, 300.0, 1.0, 0.1, 0, 1, None, 2019, 5),
            ],
        ),
        "web_traffic": (
            "date date, traffic_source string, sessions bigint, unique_visitors bigint, page_views bigint, bounce_rate double, avg_session_duration_sec double",
            [
                (date(2018, 1, 10), "seo", 100, 80, 300, 0.5, 60.0),
                (date(2018, 1, 10), "ads", 0, 0, 0, 0.7, 20.0),
                (date(2019, 5, 2), "ads", 0, 0, 0, 0.6, 10.0),
            ],
        ),
    }
    return {name: spark.createDataFrame(data, ddl) for name, (ddl, data) in rows.items()}


def by_key(df, *keys):
    """Collected rows of a small frame, keyed by the given columns."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
