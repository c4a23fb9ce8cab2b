"""Promotion answers: summaries, periods, repurchase, categories, returns and ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.expr import (
    SOLD_STATUSES,
    clip,
    in_years,
    is_true,
    known,
    period_label,
    point_change,
    safe_divide,
    sum_or_zero,
)

REPURCHASE_DAYS = 90


def promo_summary(lines: DataFrame) -> DataFrame:
    """Lines, revenue, units, mean line revenue and mean line margin with and without promotion."""
    line_margin = F.avg("line_margin_pct") if "line_margin_pct" in lines.columns else F.avg("line_revenue")
    return lines.groupBy("has_promo").agg(
        F.count(F.lit(1)).alias("lines"),
        sum_or_zero("line_revenue").alias("revenue"),
        sum_or_zero("quantity").alias("units"),
        F.avg("line_revenue").alias("avg_line_revenue"),
        line_margin.alias("margin_pct"),
    )


def promo_tradeoff(lines: DataFrame) -> DataFrame:
    """Revenue, cost, discount, margin of sums and shares with and without promotion (two rows)."""
    summed = lines.groupBy("has_promo").agg(
        F.count("order_id").alias("item_lines"),
        sum_or_zero("quantity").alias("units"),
        sum_or_zero("line_revenue").alias("revenue"),
        sum_or_zero("line_cogs").alias("cogs"),
        sum_or_zero("discount_amount").alias("discount"),
    )
    both = Window.partitionBy()
    profit = F.col("revenue") - F.col("cogs")
    return summed.withColumns(
        {
            "gross_profit": profit,
            "gross_margin": safe_divide(profit, "revenue"),
            "revenue_share": safe_divide(F.col("revenue"), F.sum("revenue").over(both)),
            "line_share": safe_divide(F.col("item_lines"), F.sum("item_lines").over(both)),
            "label": F.when(F.col("has_promo"), "Promo lines").otherwise("Non-promo lines"),
        }
    )


def sold_lines(item_level: DataFrame, first: int, last: int) -> DataFrame:
    """Lines of completed orders in the given years with net revenue floored at 0."""
    sold = F.col("order_status").isin(*SOLD_STATUSES) & in_years("order_date", first, last)
    return item_level.where(sold).withColumn("net_item_revenue", clip("net_item_revenue", lower=0.0))


def promo_order_level(lines: DataFrame) -> DataFrame:
    """Sold lines summed to orders, with the order's promotion flag."""
    return known(lines, "order_id", "customer_id", "order_date").groupBy("order_id", "customer_id", "order_date").agg(
        sum_or_zero("net_item_revenue").alias("revenue"),
        sum_or_zero("gross_merch_value").alias("gross_merch_value"),
        sum_or_zero("gross_profit").alias("gross_profit"),
        sum_or_zero("discount_amount").alias("discount_amount"),
        F.max("promo_used_flag").alias("promo_used"),
    )


def promo_days(order_level: DataFrame) -> DataFrame:
    """Order measures per day and promotion flag, with repeat purchases and eligibility.

    Orders are first summed to (customer, day, flag). Only a customer's last order of a day can be followed
    by one on a later day, so the rows that hold it and the next day with an order tell the repeats.
    Whether an order is old enough to judge depends on its date alone.
    """
    measures = ("orders", "revenue", "gross_merch_value", "gross_profit", "discount_amount")
    bought = (
        order_level.groupBy("customer_id", "order_date", "promo_used")
        .agg(F.count("order_id").alias("orders"), F.max("order_id").alias("last_id"), *[F.sum(m).alias(m) for m in measures[1:]])
        .withColumn("day", F.datediff("order_date", F.lit("1970-01-01").cast("date")))
    )
    same_day = Window.partitionBy("customer_id", "day")
    later = Window.partitionBy("customer_id").orderBy("day").rangeBetween(1, Window.unboundedFollowing)
    gap = F.min("day").over(later) - F.col("day")
    followed = is_true(gap.between(1, REPURCHASE_DAYS)) & (F.col("last_id") == F.max("last_id").over(same_day))
    per_day = (
        bought.withColumn("repeated", followed.cast("bigint"))
        .groupBy("order_date", "promo_used")
        .agg(*[F.sum(m).alias(m) for m in (*measures, "repeated")])
    )
    latest = F.max("order_date").over(Window.partitionBy())
    return per_day.withColumn("_latest", latest).withColumn(
        "eligible", is_true(F.col("order_date") <= F.date_sub("_latest", REPURCHASE_DAYS))
    ).drop("_latest")


def _if_eligible(c: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("eligible"), F.col(c))), F.lit(0))


def promo_diag(item_level: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Orders, revenue, profit, repurchase and share by period and promotion flag."""
    days = promo_days(promo_order_level(sold_lines(item_level, first, last)))
    summed = days.groupBy(period_label(F.year("order_date"), split).alias("period"), "promo_used").agg(
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        _if_eligible("orders").alias("eligible_orders_90d"),
        _if_eligible("repeated").alias("repurchase_90d"),
    )
    period = Window.partitionBy("period")
    return summed.withColumns(
        {
            "gross_margin": safe_divide("gross_profit", "revenue"),
            "repurchase_90d_rate": safe_divide("repurchase_90d", "eligible_orders_90d"),
            "total_revenue": F.sum("revenue").over(period),
            "total_orders": F.sum("orders").over(period),
        }
    ).withColumn("revenue_share", safe_divide("revenue", "total_revenue"))


def promo_effect(item_level: DataFrame, first: int, last: int) -> DataFrame:
    """Promotion against no promotion in one span of years, with discount and repurchase rates.

    The span bounds the orders considered for the repeat, too.
    """
    floored = sold_lines(item_level, first, last).withColumn(
        "gross_merch_value", clip("gross_merch_value", lower=0.0)
    )
    summed = promo_days(promo_order_level(floored)).groupBy("promo_used").agg(
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("gross_merch_value").alias("gross_merch_value"),
        F.sum("gross_profit").alias("gross_profit"),
        F.sum("discount_amount").alias("discount_amount"),
        _if_eligible("orders").alias("eligible_orders"),
        _if_eligible("repeated").alias("repurchase_90d"),
    )
    return summed.withColumns(
        {
            "revenue_share": safe_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy())),
            "gross_margin": safe_divide("gross_profit", "revenue"),
            "discount_rate": safe_divide("discount_amount", "gross_merch_value"),
            "repurchase_90d_rate": safe_divide("repurchase_90d", "eligible_orders"),
        }
    )


def promo_gaps(effect: DataFrame) -> DataFrame:
    """Promotion share of revenue (percent), and margin and repeat gaps (points), one row."""

    def pick(name: str, promo: int) -> Column:
        return F.max(F.when(F.col("promo_used") == promo, F.col(name)))

    return effect.agg(
        (pick("revenue_share", 1) * 100).alias("promo_revenue_share_pct"),
        point_change(pick("gross_margin", 1), pick("gross_margin", 0)).alias("promo_margin_gap_pp"),
        point_change(pick("repurchase_90d_rate", 1), pick("repurchase_90d_rate", 0)).alias(
            "promo_90d_repeat_gap_pp"
        ),
    )


def category_period(item_level: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Revenue, profit, promoted revenue and shares per period and category."""
    promoted = F.when(F.col("promo_used_flag") == 1, F.col("net_item_revenue")).otherwise(0.0)
    summed = (
        sold_lines(item_level, first, last)
        .where(F.col("category").isNotNull())
        .groupBy(period_label(F.year("order_date"), split).alias("period"), "category")
        .agg(
            sum_or_zero("net_item_revenue").alias("revenue"),
            sum_or_zero("gross_profit").alias("gross_profit"),
            F.sum(promoted).alias("promo_revenue"),
        )
    )
    total = F.sum("revenue").over(Window.partitionBy("period"))
    return summed.withColumns(
        {
            "gross_margin": safe_divide("gross_profit", "revenue"),
            "promo_revenue_share": safe_divide("promo_revenue", "revenue"),
            "total_period_revenue": total,
            "revenue_share": safe_divide(F.col("revenue"), total),
        }
    )


def category_regime(item_level: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Share, margin and promoted share of each category before and after the split, side by side.

    A category missing from one period keeps NULLs there, as a full outer join would give.
    """
    measures = {"revenue_share": "rev_share", "gross_margin": "gm", "promo_revenue_share": "promo_share"}
    columns = [
        F.max(F.when(F.col("period") == period, F.col(source))).alias(f"{short}_{period}")
        for period in ("pre", "post")
        for source, short in measures.items()
    ]
    return category_period(item_level, first, split, last).groupBy("category").agg(*columns)


# ---------------------------------------------------------------- returns and ratings


def return_reason_summary(returns: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Records, units and refunds per reason, and per category when products are given."""
    rows = returns
    if products is not None and "category" not in returns.columns:
        rows = rows.join(products.select("product_id", "category"), "product_id", "left")
    keys = ["return_reason"] + (["category"] if "category" in rows.columns else [])
    return known(rows, *keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("return_records"),
        sum_or_zero("return_quantity").alias("return_units"),
        sum_or_zero("refund_amount").alias("refund_amount"),
    ).orderBy(F.desc("return_records"), *keys)


def top_return_reasons(rows: DataFrame, reason: str = "top_return_reason", top: int = 10) -> DataFrame:
    """Most frequent reasons with their number of rows."""
    return (
        rows.where(F.col(reason).isNotNull())
        .groupBy(F.col(reason).alias("return_reason"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "return_reason")
        .limit(top)
    )


def rating_return(reviews: DataFrame, returns: DataFrame) -> DataFrame:
    """Share of reviewed lines that were returned, per rating."""
    returned = returns.select("order_id", "product_id").distinct().withColumn("is_returned", F.lit(1))
    rated = reviews.select("review_id", "rating", "order_id", "product_id").where(F.col("rating").isNotNull())
    return (
        rated.join(returned, ["order_id", "product_id"], "left")
        .groupBy("rating")
        .agg(
            F.count_distinct("review_id").alias("reviews"),
            F.coalesce(F.sum("is_returned"), F.lit(0)).alias("returned_review_items"),
        )
        .withColumn("return_rate_among_reviewed", safe_divide("returned_review_items", "reviews"))
    )
