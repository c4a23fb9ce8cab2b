"""The retail tables expressed over the TPC-H-like test tables.

Column meanings follow FIXTURES.md section 3; every view is a lazy DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Explicit schemas: no footer-reading job per table.
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


# Base tables and keys on which the key of a view rests: it repeats in the view only if one of them repeats. Shipments are
# summed by their key and rest on none.
KEY_OWNERS = {
    "orders": [("orders", "o_orderkey"), ("customer", "c_custkey")],
    "payments": [("orders", "o_orderkey")],
    "products": [("part", "p_partkey")],
    "customers": [("customer", "c_custkey")],
    "geography": [("nation", "n_nationkey"), ("region", "r_regionkey")],
    "shipments": [],
}


class RetailViews:
    """Retail tables by attribute-like methods; nothing is read until an action runs."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.schema(DRIVER_TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def line_count(self) -> int:
        """Rows of the largest table, from its files' footers; 0 if it is not there."""
        try:
            return self.base("lineitem").count()
        except AnalysisException:
            return 0

    def owners(self, *views: str) -> dict[str, tuple[DataFrame, list[str]]]:
        """Base tables that own the keys of the views, for checks that need not compute the views."""
        found = dict.fromkeys(owner for view in views for owner in KEY_OWNERS[view])
        return {f"{table}.{key}": (self.base(table).select(key), [key]) for table, key in found}

    def orders(self) -> DataFrame:
        # Only the customer key and nation travel; Spark broadcasts them when small enough.
        place = self.base("customer").selectExpr("c_custkey as customer_id", "c_nationkey as zip")
        joined = self.orders_without_place().join(place, "customer_id", "left")
        return joined.select("order_id", "order_date", "customer_id", "zip", "order_status", "payment_method")

    def orders_without_place(self) -> DataFrame:
        """Orders for answers that need no zip: spares the join with all customers.

        Both views hold the same orders: one whose customer is unknown has no zip there.
        """
        return self.base("orders").selectExpr(
            "o_orderkey as order_id",
            "cast(o_orderdate as date) as order_date",
            "o_custkey as customer_id",
            "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'cancelled' end as order_status",
            "o_orderpriority as payment_method",
        )

    def order_items(self) -> DataFrame:
        return self.base("lineitem").selectExpr(
            "l_orderkey as order_id",
            "l_partkey as product_id",
            "l_quantity as quantity",
            "l_extendedprice / l_quantity as unit_price",
            "l_extendedprice * l_discount as discount_amount",
            "case when l_discount >= 0.05D then concat('P', cast(round(l_discount * 100) as int)) end as promo_id",
            "case when l_discount >= 0.09D then 'X' end as promo_id_2",
        )

    def products(self) -> DataFrame:
        return self.base("part").selectExpr(
            "p_partkey as product_id",
            "p_name as product_name",
            "p_type as category",
            "p_brand as segment",
            "p_size as size",
            "2.0D * p_retailprice as price",
            "1.6D * p_retailprice as cogs",
        )

    def customers(self) -> DataFrame:
        return self.base("customer").selectExpr(
            "c_custkey as customer_id", "c_nationkey as zip", "c_mktsegment as age_group"
        )

    def geography(self) -> DataFrame:
        return (
            self.base("nation")
            .join(self.base("region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr("n_nationkey as zip", "n_name as district", "r_name as region")
        )

    def payments(self) -> DataFrame:
        return self.base("orders").selectExpr(
            "o_orderkey as order_id",
            "o_totalprice as payment_value",
            "cast(1 + o_orderkey % 12 as int) as installments",
        )

    def shipments(self) -> DataFrame:
        # Lines are summed per order before the join, so an order with many lines stays one row.
        shipped = (
            self.base("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.expr("min(l_shipdate)").alias("first_shipped"),
                F.expr("max(l_shipdate)").alias("last_shipped"),
                F.expr("sum(l_tax * l_extendedprice)").alias("shipping_fee"),
            )
        )
        sendable = self.base("orders").where("o_orderstatus <> 'P'").select("o_orderkey")
        return shipped.join(sendable, F.expr("l_orderkey = o_orderkey"), "left_semi").selectExpr(
            "l_orderkey as order_id",
            "cast(first_shipped as date) as ship_date",
            "cast(last_shipped as date) as delivery_date",
            "shipping_fee",
        )

    def returns(self) -> DataFrame:
        return self.base("lineitem").where("l_returnflag = 'R'").selectExpr(
            "l_orderkey * 10 + l_linenumber as return_id",
            "l_orderkey as order_id",
            "l_partkey as product_id",
            "cast(l_shipdate as date) as return_date",
            "case l_linenumber % 4 when 0 then 'wrong_size' when 1 then 'defective' when 2 then 'late_delivery' "
            "else 'changed_mind' end as return_reason",
            "l_quantity as return_quantity",
            "l_extendedprice * (1 - l_discount) as refund_amount",
        )

    def reviews(self) -> DataFrame:
        buyer = self.base("orders").select("o_orderkey", "o_custkey")
        return (
            self.base("lineitem")
            .where("l_returnflag in ('A', 'R')")
            .join(buyer, F.expr("l_orderkey = o_orderkey"))
            .selectExpr(
                "l_orderkey * 10 + l_linenumber as review_id",
                "l_orderkey as order_id",
                "l_partkey as product_id",
                "o_custkey as customer_id",
                "cast(l_shipdate as date) as review_date",
                "cast(1 + (l_partkey + l_linenumber) % 5 as int) as rating",
            )
        )

    def sales(self) -> DataFrame:
        """Daily revenue and cost: one row per calendar day with orders."""
        cost = self.base("part").select("p_partkey", "p_retailprice")
        day = self.base("orders").selectExpr("o_orderkey", "cast(o_orderdate as date) as Date")
        return (
            self.base("lineitem")
            .join(cost, F.expr("l_partkey = p_partkey"), "left")
            .join(day, F.expr("l_orderkey = o_orderkey"))
            .groupBy("Date")
            .agg(
                F.expr("sum(l_extendedprice * (1 - l_discount))").alias("Revenue"),
                F.expr("sum(l_quantity * 1.6D * p_retailprice)").alias("COGS"),
            )
        )

    def web_traffic(self) -> DataFrame:
        lines = self.base("lineitem").selectExpr("*", "cast(l_shipdate as date) as date")
        return lines.groupBy("date", F.col("l_returnflag").alias("traffic_source")).agg(
            F.expr("count(*)").alias("sessions"),
            F.expr("count(distinct l_suppkey)").alias("unique_visitors"),
            F.expr("sum(l_quantity)").alias("page_views"),
            F.expr("avg(l_discount)").alias("bounce_rate"),
            F.expr("avg(l_tax) * 1000").alias("avg_session_duration_sec"),
        )

    def event_traffic(self) -> DataFrame:
        events = self.base("events").selectExpr("*", "cast(ts as date) as date")
        return events.groupBy("date", F.col("event_type").alias("traffic_source")).agg(
            F.expr("count(*)").alias("sessions"),
            F.expr("count(distinct user_id)").alias("unique_visitors"),
            F.expr("count(*)").alias("page_views"),
            F.expr("avg(case when value < 20 then 1.0D else 0.0D end)").alias("bounce_rate"),
            F.expr("avg(value)").alias("avg_session_duration_sec"),
        )

    def inventory(self) -> DataFrame:
        # Units are summed per product and month first; product attributes join the smaller result.
        sold = (
            self.base("lineitem")
            .selectExpr("last_day(cast(l_shipdate as date)) as snapshot_date", "l_partkey", "l_quantity")
            .groupBy("snapshot_date", "l_partkey")
            .agg(F.expr("sum(l_quantity)").alias("units_sold"))
        )
        return sold.join(self.base("part"), F.expr("l_partkey = p_partkey"), "left").selectExpr(
            "snapshot_date",
            "l_partkey as product_id",
            "p_type as category",
            "p_brand as segment",
            "p_name as product_name",
            "units_sold",
            "p_size * 4 as stock_on_hand",
            "greatest(0.0D, least(30.0D, units_sold - p_size)) as stockout_days",
            "30.0D * p_size / units_sold as days_of_supply",
            "least(1.0D, p_size / units_sold) as fill_rate",
            "units_sold / (units_sold + p_size) as sell_through_rate",
            "case when units_sold > p_size then 1 else 0 end as stockout_flag",
            "case when units_sold < 0.5D * p_size then 1 else 0 end as overstock_flag",
            "case when units_sold > 0.8D * p_size then 1 else 0 end as reorder_flag",
        )

    # (view name, method) in the order the audit reports list them.
    NAMES = (
        "products", "customers", "geography", "orders", "order_items", "payments", "shipments", "returns",
        "reviews", "sales", "inventory", "web_traffic",
    )

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in (names or self.NAMES)}
