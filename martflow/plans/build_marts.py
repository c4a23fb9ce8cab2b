"""Build the interim tables and marts from the raw tables and write them as Parquet layers.

The order-line fact feeds the order, customer, product and product-month tables, so it is written
once, partitioned by order month, and read back: later steps start from files instead of repeating
its joins, and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

import argparse
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators import joins, marts, quality
from martflow.plans import audit
from martflow.session import build_session
from martflow.sources.raw import load_raw_data
from martflow.sources.schema import MART_KEYS
from martflow.sources.writers import save_bucketed, save_csv, save_layer, save_months


def write_joined_tables(t: dict[str, DataFrame], interim_dir: str) -> dict[str, DataFrame]:
    """The nine joined tables. Call :func:`require_join_keys` first; the joins do not repeat that check."""
    built = {
        "orders_payments": joins.orders_payments(t["orders"], t["payments"]),
        "items_orders": joins.items_orders(t["order_items"], t["orders"], checked=False),
        "items_products": joins.items_products(t["order_items"], t["products"], checked=False),
        "items_returns": joins.items_returns(t["order_items"], t["returns"]),
        "items_reviews": joins.items_reviews(t["order_items"], t["reviews"]),
        "items_double_promotions": joins.items_double_promotions(t["order_items"]),
        "orders_customers": joins.orders_customers(t["orders"], t["customers"], checked=False),
        "orders_geography": joins.orders_geography(t["orders"], t["geography"], checked=False),
        "orders_shipments": joins.orders_shipments(t["orders"], t["shipments"], checked=False),
    }
    return {name: save_layer(df, interim_dir, name) for name, df in built.items()}


def require_join_keys(t: dict[str, DataFrame]) -> None:
    """Check every join key once, before any fact is built on it."""
    quality.require_unique({name: (t[name], key) for name, key in marts.JOIN_KEYS.items() if name in t})


#: Tables that meet by order.
BY_ORDER = ("orders", "order_items", "payments", "shipments", "returns", "reviews")
#: Rows of one order beyond which its bucket would be a task of its own size.
HOT_ORDER_ROWS = 100_000


def bucket_by_order(
    t: dict[str, DataFrame], out_dir: str, buckets: int, hot_rows: int = HOT_ORDER_ROWS
) -> dict[str, DataFrame]:
    """The tables with those that meet by order written once in buckets of ``order_id``.

    Each is shuffled once here instead of once in every join and aggregation of a build. Bucketed joins are never
    split at run time, so a table in which one order (or the missing one) has more than ``hot_rows`` rows stays as
    it is; to know that, rows are counted per order, before any shuffle.
    """
    spark = t["orders"].sparkSession
    known = [name for name in BY_ORDER if name in t]
    largest = [
        t[name].groupBy("order_id").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("most")).select(F.lit(name).alias("table"), "most")
        for name in known
    ]
    # one row a table
    cool = [r["table"] for r in quality.union_all(largest).collect() if r["most"] <= hot_rows]
    mark = uuid.uuid4().hex[:12]
    written = {name: save_bucketed(t[name], f"{out_dir}/bucketed/{name}", f"{name}_{mark}", "order_id", buckets) for name in cool}
    return {**t, **written}


def refresh_facts(t: dict[str, DataFrame], out_dir: str, months: list[str]) -> tuple[DataFrame, DataFrame]:
    """(item fact, order fact) after the rows of the given order months (``yyyy-MM``) have been built anew.

    Only orders of these months are read from the raw tables on, and only their lines are joined; the order fact
    takes its lines from the month folders of the written item fact. An order that moved from one month to
    another needs both. Orders without a date have no month and stay as the last whole build left them.
    """
    day = F.col("order_date")
    first = F.date_trunc("month", day).cast("date")
    # as dates, so that the condition reaches the scan
    wanted = first.isin([date.fromisoformat(f"{m}-01") for m in months])
    orders = t["orders"].where(wanted)
    lines = t["order_items"].join(orders.select("order_id"), "order_id", "left_semi")
    items = marts.item_fact(
        lines, orders, t["products"], t["customers"], t["geography"], t["payments"], t["shipments"], t["returns"], t["reviews"],
        checked=False,
    )
    interim = f"{out_dir}/interim"
    item_fact = save_months(items, interim, "item_fact", "order_date", months)
    fresh = orders.sparkSession.read.parquet(f"{interim}/item_fact").where(F.col("month_part").isin(months)).drop("month_part")
    order_fact = marts.order_fact(orders, fresh, t["customers"], t["geography"], t["payments"], t["shipments"], checked=False)
    return item_fact, save_months(order_fact, interim, "order_fact", "order_date", months)


def build_facts(t: dict[str, DataFrame], interim_dir: str) -> tuple[DataFrame, DataFrame]:
    """(item fact, order fact), both written."""
    item_fact = marts.item_fact(
        t["order_items"], t["orders"], t["products"], t["customers"], t["geography"], t["payments"],
        t["shipments"], t["returns"], t["reviews"], checked=False,
    )
    item_fact = save_layer(item_fact, interim_dir, "item_fact", month_of="order_date")
    order_fact = marts.order_fact(
        t["orders"], item_fact, t["customers"], t["geography"], t["payments"], t["shipments"], checked=False
    )
    return item_fact, save_layer(order_fact, interim_dir, "order_fact", month_of="order_date")


def build_marts(t: dict[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """All facts and marts under ``out_dir/interim`` and ``out_dir/marts``; returns them read back.

    Call :func:`require_join_keys` first; the builders do not repeat that check.
    """
    interim, layer = f"{out_dir}/interim", f"{out_dir}/marts"
    item_fact, order_fact = build_facts(t, interim)
    built = {
        "customer_360": marts.customer_360(t["customers"], order_fact),
        "product_360": marts.product_360(t["products"], item_fact),
        "daily_panel": marts.daily_panel(t["sales"], t["web_traffic"], order_fact),
        "product_month_panel": marts.product_month_panel(
            t["inventory"], t["products"], item_fact.where(F.col("order_date").isNotNull())
        ),
    }
    written = {name: save_layer(df, layer, name) for name, df in built.items()}
    return {"item_fact": item_fact, "order_fact": order_fact, **written}


def build_light_marts(t: dict[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """The lighter definitions: line fact, customer and product marts, daily business panel."""
    fact = marts.order_line_fact(
        t["order_items"], t["orders"], t["products"], t.get("payments"), t.get("shipments"),
        t.get("returns"), t.get("reviews"), checked=False,
    )
    fact = save_layer(fact, f"{out_dir}/interim", "order_line_fact", month_of="order_date")
    built = {
        "customer_mart": marts.customer_mart(t["customers"], t["orders"], fact),
        "product_mart": marts.product_mart(t["products"], fact, t.get("inventory")),
        "daily_business_panel": marts.daily_business_panel(t["sales"], t.get("web_traffic"), t["orders"]),
    }
    written = {name: save_layer(df, f"{out_dir}/marts", name) for name, df in built.items()}
    return {"order_line_fact": fact, **written}


def write_build_reports(
    t: dict[str, DataFrame], joined: dict[str, DataFrame], built: dict[str, DataFrame], out_dir: str
) -> None:
    """Checks of the keys and joins, and the audit of all joined and built tables, from the written files."""
    save_csv(quality.cardinality_checks(t), f"{out_dir}/reports/cardinality_checks")
    save_csv(joins.join_log(t), f"{out_dir}/reports/join_logs")
    checks = {name: (built[name], *MART_KEYS[name]) for name in MART_KEYS}
    save_csv(quality.mart_checks(checks), f"{out_dir}/reports/output_datamart_checks")
    audit.write_reports(audit.built_reports({**joined, **{name: built[name] for name in MART_KEYS}}), f"{out_dir}/reports")


def run(spark: SparkSession, data_dir: str, out_dir: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The whole job; ``buckets`` writes the tables that meet by order in so many buckets first."""
    tables = load_raw_data(spark, data_dir)
    require_join_keys(tables)
    if buckets:
        tables = bucket_by_order(tables, out_dir, buckets)
    joined = write_joined_tables(tables, f"{out_dir}/interim")
    built = build_marts(tables, out_dir)
    light = build_light_marts(tables, out_dir)
    write_build_reports(tables, joined, built, out_dir)
    return {**built, **light}


def main() -> None:
    parser = argparse.ArgumentParser(description="Build interim tables and marts from raw CSV files.")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--out-dir", required=True)
    parser.add_argument("--buckets", type=int, help="buckets by order of the raw tables; none by default")
    parser.add_argument("--months", nargs="*", help="only rebuild the facts of these order months (yyyy-MM)")
    args = parser.parse_args()
    spark = build_session("martflow-build-marts")
    if args.months:
        tables = load_raw_data(spark, args.data_dir)
        require_join_keys(tables)
        refresh_facts(tables, args.out_dir, args.months)
    else:
        run(spark, args.data_dir, args.out_dir, args.buckets)


if __name__ == "__main__":
    main()
