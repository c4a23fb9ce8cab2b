"""Product answers: categories, ABC, SKU operations and the three SKU action rules.

Cut points are exact quantiles over all products. The SKU table is materialized once, then read for
the quantiles and for the labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.calendar import month_start
from martflow.functions.expr import SOLD_STATUSES, clip, in_years, is_true, known, safe_divide, sum_or_zero
from martflow.functions.ordering import exact_quantiles, materialize

# Labels of the median rule.
PRIORITY, PROTECT, SELECTIVE, REDUCE = (
    "Priority Replenish", "Protect Winners", "Selective Reorder", "Reduce/Markdown",
)

# Labels of the 70th-percentile rule.
REORDER, MONITOR, MARKDOWN, REVIEW = (
    "Reorder / protect", "Monitor / maintain", "Markdown / rationalize", "Review",
)

# Labels of the six-bucket rule.
BUCKET_REFILL = "Refill trước"
BUCKET_PROTECT = "Bảo vệ SKU thắng"
BUCKET_CLEAR = "Clear tồn chậm"
BUCKET_TWO_WAY = "Chẩn đoán 2 chiều"
BUCKET_WATCH = "Theo dõi"
BUCKET_DIAGNOSE = "Chẩn đoán từng SKU"


def category_summary(lines: DataFrame) -> DataFrame:
    """Revenue, units, orders, mean line margin and promoted line share per category."""
    line_margin = F.avg("line_margin_pct") if "line_margin_pct" in lines.columns else F.avg("line_revenue")
    return (
        lines.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            sum_or_zero("line_revenue").alias("revenue"),
            sum_or_zero("quantity").alias("units"),
            F.count_distinct("order_id").alias("orders"),
            line_margin.alias("margin_pct"),
            F.avg(F.col("has_promo").cast("int")).alias("promo_line_rate"),
        )
        .orderBy(F.desc("revenue"))
    )


def category_contribution(lines: DataFrame) -> DataFrame:
    """Revenue, cost, units, lines, margin of sums and revenue share per category."""
    summed = (
        lines.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            sum_or_zero("line_revenue").alias("revenue"),
            sum_or_zero("line_cogs").alias("cogs"),
            sum_or_zero("quantity").alias("units"),
            F.count("order_id").alias("item_lines"),
        )
    )
    profit = F.col("revenue") - F.col("cogs")
    return summed.withColumns(
        {
            "gross_profit": profit,
            "gross_margin": safe_divide(profit, "revenue"),
            "revenue_share": safe_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy())),
        }
    )


def abc_summary(product_360: DataFrame) -> DataFrame:
    """Products, revenue, mean margin and revenue share per ABC class."""
    summed = product_360.where(F.col("abc_class").isNotNull()).groupBy("abc_class").agg(
        F.count_distinct("product_id").alias("n_skus"),
        F.sum("revenue").alias("revenue"),
        F.avg("gross_margin").alias("avg_margin"),
    )
    share = safe_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy()))
    return summed.withColumn("revenue_share", share)


# ---------------------------------------------------------------- median rule


def sku_action_matrix(product_mart: DataFrame) -> DataFrame:
    """Label products by revenue and stockout days against their medians."""
    skus = materialize(product_mart)
    present = {
        name: (c, 0.5) for name, c in {"rev": "revenue", "stock": "avg_stockout_days"}.items() if c in skus.columns
    }
    cuts = exact_quantiles(skus, present)

    def at_least_median(name: str, c: str) -> Column:
        return is_true(F.col(c) >= cuts[name]) if name in cuts else F.lit(True)

    high_revenue = at_least_median("rev", "revenue")
    high_stockout = at_least_median("stock", "avg_stockout_days")
    label = (
        F.when(high_revenue & high_stockout, PRIORITY)
        .when(high_revenue, PROTECT)
        .when(high_stockout, SELECTIVE)
        .otherwise(REDUCE)
    )
    return skus.withColumn("sku_action", label)


def sku_action_totals(action_matrix: DataFrame) -> DataFrame:
    stock = "avg_stockout_days" if "avg_stockout_days" in action_matrix.columns else "revenue"
    return (
        action_matrix.groupBy("sku_action")
        .agg(
            F.count_distinct("product_id").alias("sku_count"),
            F.sum("revenue").alias("revenue"),
            F.avg(stock).alias("avg_stockout_days"),
        )
        .orderBy(F.desc("revenue"))
    )


# ---------------------------------------------------------------- 70th-percentile rule


def sku_ops(panel: DataFrame, product_360: DataFrame | None = None) -> DataFrame:
    """Stock and sales of each product over all months.

    When the panel carries no revenue at all, revenue is taken from the product table.
    """
    measures = [
        F.sum("units_sold").alias("units_sold"),
        F.avg("stock_on_hand").alias("stock_on_hand"),
        F.avg("stockout_days").alias("stockout_days"),
        F.avg("stockout_flag").alias("stockout_rate"),
        F.avg("overstock_flag").alias("overstock_rate"),
        F.avg("reorder_flag").alias("reorder_rate"),
        F.avg("sell_through_rate").alias("sell_through_rate"),
        sum_or_zero("item_revenue" if "item_revenue" in panel.columns else F.lit(0.0)).alias("revenue"),
    ]
    keys = ["product_id", "product_name", "category", "segment"]
    skus = known(panel, *keys).groupBy(*keys).agg(*measures)
    if product_360 is None:
        return skus
    skus = materialize(skus)
    total = skus.agg(F.sum("revenue")).scalar()
    fallback = product_360.select("product_id", F.col("revenue").alias("_listed"))
    revenue = F.when(total == 0, F.coalesce("_listed", F.lit(0.0))).otherwise(F.col("revenue"))
    return skus.join(fallback, "product_id", "left").withColumn("revenue", revenue).drop("_listed")


def sku_action_q70(skus: DataFrame, p: float = 0.70) -> DataFrame:
    """Label products by revenue, stockout rate and overstock rate against their 70th percentiles."""
    skus = materialize(skus)
    cuts = exact_quantiles(
        skus, {"rev": ("revenue", p), "stock": ("stockout_rate", p), "over": ("overstock_rate", p)}
    )
    revenue, stockout = F.col("revenue"), F.col("stockout_rate")
    action = (
        F.when((revenue >= cuts["rev"]) & (stockout >= cuts["stock"]), REORDER)
        .when((revenue >= cuts["rev"]) & (stockout < cuts["stock"]), MONITOR)
        .when((revenue < cuts["rev"]) & (F.col("overstock_rate") >= cuts["over"]), MARKDOWN)
        .otherwise(REVIEW)
    )
    return skus.withColumn("action", action)


def sku_action_summary(labelled: DataFrame) -> DataFrame:
    """Products, revenue, mean rates and revenue share per action."""
    summed = labelled.groupBy("action").agg(
        F.count_distinct("product_id").alias("n_skus"),
        F.sum("revenue").alias("revenue"),
        F.avg("stockout_rate").alias("avg_stockout_rate"),
        F.avg("overstock_rate").alias("avg_overstock_rate"),
        F.avg("sell_through_rate").alias("avg_sell_through"),
    )
    share = safe_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy()))
    return summed.withColumn("revenue_share", share)


# ---------------------------------------------------------------- six-bucket rule


def sku_months(inventory: DataFrame, item_level: DataFrame, first: int, last: int) -> DataFrame:
    """Stock measures and net revenue per product and month; stock rows decide which months exist."""
    sold = F.col("order_status").isin(*SOLD_STATUSES) & in_years("order_date", first, last)
    revenue = (
        item_level.where(sold)
        .groupBy("product_id", month_start("order_date").alias("month"))
        .agg(sum_or_zero("net_item_revenue").alias("revenue"))
    )
    rates = ["sell_through_rate", "stockout_days", "stockout_flag", "overstock_flag", "fill_rate"]
    stock = (
        inventory.where(in_years("snapshot_date", first, last))
        .groupBy("product_id", month_start("snapshot_date").alias("month"))
        .agg(*[F.avg(F.col(c).try_cast("double")).alias(c) for c in rates])
    )
    capped = {c: clip(c, lower=0.0, upper=1.0) for c in ("stockout_flag", "overstock_flag", "fill_rate")}
    floored = {c: clip(c, lower=0.0) for c in ("sell_through_rate", "stockout_days")}
    return (
        stock.join(revenue, ["product_id", "month"], "left")
        .withColumns({"revenue": F.coalesce("revenue", F.lit(0.0)), **capped, **floored})
    )


def sku_buckets(inventory: DataFrame, item_level: DataFrame, first: int, last: int) -> DataFrame:
    """Six action buckets from quartiles of sell-through, stockout days and overstock rate."""
    skus = (
        sku_months(inventory, item_level, first, last)
        .groupBy("product_id")
        .agg(
            F.avg("sell_through_rate").alias("sell_through_avg"),
            F.avg("stockout_days").alias("stockout_days_avg"),
            F.avg("stockout_flag").alias("stockout_rate"),
            F.avg("overstock_flag").alias("overstock_rate"),
            F.avg("fill_rate").alias("fill_rate_avg"),
            F.sum("revenue").alias("revenue_total"),
            F.count("month").alias("active_months"),
        )
        .withColumn("avg_monthly_revenue", safe_divide("revenue_total", "active_months", 0.0))
        .where(F.col("sell_through_avg").isNotNull() & F.col("stockout_days_avg").isNotNull())
    )
    skus = materialize(skus)
    cuts = exact_quantiles(
        skus,
        {
            "sell_low": ("sell_through_avg", 0.25),
            "sell_high": ("sell_through_avg", 0.75),
            "stock_low": ("stockout_days_avg", 0.25),
            "stock_high": ("stockout_days_avg", 0.75),
            "over_high": ("overstock_rate", 0.75),
        },
    )
    high_sell, low_sell = F.col("sell_through_avg") >= cuts["sell_high"], F.col("sell_through_avg") <= cuts["sell_low"]
    high_stock = F.col("stockout_days_avg") >= cuts["stock_high"]
    low_stock = F.col("stockout_days_avg") <= cuts["stock_low"]
    high_over = is_true(F.col("overstock_rate") >= cuts["over_high"])
    bucket = (
        F.when(high_sell & high_stock, BUCKET_REFILL)
        .when(high_sell & low_stock, BUCKET_PROTECT)
        .when(low_sell & high_over, BUCKET_CLEAR)
        .when(high_stock & high_over, BUCKET_TWO_WAY)
        .when(~(high_sell | low_sell | high_stock | high_over), BUCKET_WATCH)
        .otherwise(BUCKET_DIAGNOSE)
    )
    return skus.withColumn("action_bucket", bucket)


def sku_bucket_summary(bucketed: DataFrame) -> DataFrame:
    """Products, revenue, monthly revenue and product share per bucket."""
    summed = bucketed.groupBy("action_bucket").agg(
        F.count("product_id").alias("sku_count"),
        F.sum("revenue_total").alias("revenue_total"),
        F.sum("avg_monthly_revenue").alias("avg_monthly_revenue"),
    )
    return summed.withColumns(
        {
            "sku_share": safe_divide(F.col("sku_count"), F.sum("sku_count").over(Window.partitionBy())),
            "avg_monthly_revenue_mn": F.col("avg_monthly_revenue") / 1e6,
        }
    )
