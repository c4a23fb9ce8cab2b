"""Readers for the raw retail tables (CSV at rest, or Parquet once loaded)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.expr import any_present, flag, keep_present
from martflow.sources.schema import RAW_TABLES

# Texts read as missing in addition to the empty field.
MISSING_TEXT = ["NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "None", "#N/A", "<NA>"]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names (local, HDFS, object store)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip blanks around the header names."""
    return df.toDF(*[c.strip() for c in df.columns])


def _typed(name: str, ddl: str) -> Column:
    raw = F.when(~F.trim(F.col(name)).isin(MISSING_TEXT), F.col(name))
    if ddl == "string":
        return raw.alias(name)
    if ddl == "date":
        # A date may carry a time part; an unreadable one becomes NULL.
        return F.try_to_date(F.substring(F.trim(raw), 1, 10), "yyyy-MM-dd").alias(name)
    if ddl in ("int", "bigint"):
        # Columns with gaps are often written as 3.0.
        return raw.try_cast("double").try_cast(ddl).alias(name)
    value = raw.try_cast(ddl)
    return F.when(~F.isnan(value), value).alias(name)


def read_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header. Known columns are cast by name, others stay text; no inference pass."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no CSV file or folder at {path}")
    text = normalize_columns(spark.read.option("header", True).option("inferSchema", False).csv(path))
    types = types or {}
    return text.select(*[_typed(c, types.get(c, "string")) for c in text.columns])


def load_table(spark: SparkSession, name: str, data_dir: str) -> DataFrame:
    table = name.removesuffix(".csv")
    return read_csv(spark, f"{data_dir}/{table}.csv", RAW_TABLES.get(table))


def load_raw_data(
    spark: SparkSession, data_dir: str, required: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """All raw tables by name; one error lists every missing file."""
    names = [n.removesuffix(".csv") for n in (required or RAW_TABLES)]
    missing = [n for n in names if not path_exists(spark, f"{data_dir}/{n}.csv")]
    if missing:
        raise FileNotFoundError("Missing raw files: " + ", ".join(f"{n}.csv" for n in missing))
    return {n: load_table(spark, n, data_dir) for n in names}


def sales_by_date(sales: DataFrame) -> DataFrame:
    """Daily sales with the date column named ``date``."""
    return sales.select(F.col("Date").alias("date"), "Revenue", "COGS")


def order_level(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their summed payment (0 when unpaid), pruned to the columns the answers use."""
    if "payment_value" not in payments.columns:
        raise ValueError("payments has no payment_value column")
    kept = keep_present(
        orders,
        ["order_id", "order_date", "customer_id", "order_status", "payment_method", "device_type",
         "order_source", "zip"],
    )
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))
    return kept.join(paid, "order_id", "left").withColumn(
        "payment_value", F.coalesce("payment_value", F.lit(0.0))
    )


def item_level(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with order and product context and net money; given measures are kept as they are."""
    kept_orders = keep_present(orders, ["order_id", "customer_id", "order_date", "order_status"])
    kept_products = keep_present(
        products, ["product_id", "product_name", "category", "segment", "price", "cogs"]
    )
    items = order_items.join(kept_orders, "order_id", "left").join(kept_products, "product_id", "left")
    have = set(items.columns)

    discount = F.coalesce("discount_amount", F.lit(0.0)) if "discount_amount" in have else F.lit(0.0)
    items = items.withColumn("discount_amount", discount)
    if "gross_merch_value" not in have:
        items = items.withColumn("gross_merch_value", F.col("quantity") * F.col("unit_price"))
    if "net_item_revenue" not in have:
        items = items.withColumn("net_item_revenue", F.col("gross_merch_value") - F.col("discount_amount"))
    if "item_cogs" not in have:
        if "cogs" not in have:
            raise ValueError("products has no cogs column")
        items = items.withColumn("item_cogs", F.col("quantity") * F.col("cogs"))
    if "gross_profit" not in have:
        items = items.withColumn("gross_profit", F.col("net_item_revenue") - F.col("item_cogs"))
    if "promo_used_flag" not in have:
        items = items.withColumn("promo_used_flag", promo_used_flag(items.columns))
    return items


def promo_used_flag(columns: Iterable[str]) -> Column:
    """1 when any promotion id is set; without promotion columns, 1 when a discount was given."""
    promo = [c for c in ("promo_id", "promo_id_p1", "promo_id_2", "promo_id_p2") if c in set(columns)]
    return flag(any_present(promo)) if promo else flag(F.col("discount_amount") > 0)
