"""Customer answers: yearly health, order gaps, 90-day repurchase, age groups, payments, lead times.

Gaps between a customer's orders are found on (customer, day) rows: orders of one day are counted
first, so a window over one customer never holds more rows than the calendar has days, however many
orders that customer placed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.expr import (
    SOLD_STATUSES,
    flag,
    in_years,
    is_true,
    known,
    period_label,
    safe_divide,
)
from martflow.functions.ordering import materialize
from martflow.operators.joins import group_share
from martflow.operators.revenue import compare_periods


def sold_orders(orders: DataFrame, first: int, last: int) -> DataFrame:
    return orders.where(F.col("order_status").isin(*SOLD_STATUSES) & in_years("order_date", first, last))


def customer_health(order_level: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Active customers, orders, revenue, frequency, order value and repeat rate per year."""
    per_customer = (
        sold_orders(order_level, first, last)
        .groupBy(F.year("order_date").alias("year"), "customer_id")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("payment_value").alias("revenue"))
    )
    has_customer = F.col("customer_id").isNotNull()
    yearly = per_customer.groupBy("year").agg(
        F.count("customer_id").alias("active_customers"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.avg(F.when(has_customer, flag(F.col("orders") >= 2))).alias("repeat_rate"),
    )
    return yearly.withColumns(
        {
            "orders_per_active_customer": safe_divide("orders", "active_customers"),
            "aov": safe_divide("revenue", "orders"),
            "period": period_label("year", split),
        }
    )


def customer_health_shift(order_level: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Change between the mean year before and after the split."""
    measures = ["active_customers", "orders_per_active_customer", "repeat_rate", "aov"]
    mean_year = (
        customer_health(order_level, first, split, last)
        .groupBy("period")
        .agg(*[F.avg(m).alias(m) for m in measures])
    )
    return compare_periods(
        mean_year,
        {
            "active_customers_change_pct": ("active_customers", "pct"),
            "orders_per_customer_change_pct": ("orders_per_active_customer", "pct"),
            "repeat_rate_change_pp": ("repeat_rate", "points"),
            "aov_change_pct": ("aov", "pct"),
        },
    )


def customer_days(orders: DataFrame) -> DataFrame:
    """One row per customer and order day: orders, first and last order id, neighbouring days."""
    days = (
        known(orders, "customer_id", "order_date")
        .groupBy("customer_id", "order_date")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("order_id").alias("last_order_id"))
    )
    by_day = Window.partitionBy("customer_id").orderBy("order_date")
    return days.withColumns(
        {
            "prev_day": F.lag("order_date").over(by_day),
            "next_day": F.lead("order_date").over(by_day),
        }
    )


def order_gap_counts(orders: DataFrame) -> DataFrame:
    """(gap_days, n): how often each gap to the customer's previous order occurs.

    The first order of a day follows the previous day's last one; all others have a gap of 0.
    """
    gaps = F.array(
        F.struct(F.datediff("order_date", "prev_day").alias("gap_days"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit(0).alias("gap_days"), (F.col("n_orders") - 1).alias("n")),
    )
    return (
        customer_days(orders)
        .select(F.explode(gaps).alias("g"))
        .select("g.*")
        .where(F.col("gap_days").isNotNull() & (F.col("n") > 0))
        .groupBy("gap_days")
        .agg(F.sum("n").alias("n"))
    )


def order_gap_stats(orders: DataFrame) -> DataFrame:
    """Repeat orders (orders beyond each customer's first) and median, mean, 75th percentile gap.

    Percentiles weigh the distinct gaps, of which there are at most as many as days.
    """
    gap, n = F.col("gap_days"), F.col("n")
    stats = order_gap_counts(orders).agg(
        F.sum("n").cast("double").alias("repeat_orders"),
        F.percentile(gap, F.lit(0.5), n).alias("median_inter_order_gap"),
        safe_divide(F.sum(gap * n), F.sum(n)).alias("mean_inter_order_gap"),
        F.percentile(gap, F.lit(0.75), n).alias("p75_inter_order_gap"),
    )
    entries = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in stats.columns])
    return stats.select(F.explode(entries).alias("e")).select("e.*")


def equal_width_bins(counts: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram of whole numbers given as (value, n); the last bin is closed."""
    everything = Window.partitionBy()
    low, high = F.min(value).over(everything), F.max(value).over(everything)
    placed = counts.withColumns({"_low": low, "_high": high})
    width = F.col("_high") - F.col("_low")
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide((F.col(value) - F.col("_low")) * bins, width)), F.lit(bins - 1))
    )
    edge = F.col("_low") + width * F.col("bin") / F.lit(bins)
    return (
        placed.withColumn("bin", index.cast("int"))
        .groupBy("bin", "_low", "_high")
        .agg(F.sum("n").alias("n"))
        .select("bin", edge.alias("bin_start"), (edge + width / F.lit(bins)).alias("bin_end"), "n")
    )


def order_gap_histogram(orders: DataFrame, bins: int = 40, clip_at: int = 730) -> DataFrame:
    """Histogram of gaps; longer gaps count as ``clip_at``."""
    clipped = (
        order_gap_counts(orders)
        .groupBy(F.least("gap_days", F.lit(clip_at)).alias("gap_days"))
        .agg(F.sum("n").alias("n"))
    )
    return equal_width_bins(clipped, "gap_days", bins)


def with_next_order(order_level: DataFrame, customer_day: DataFrame) -> DataFrame:
    """Date of the customer's next order, ordered by date and order id.

    Only the last order of a day looks ahead to another day. The join key (customer, day) is coarse
    on purpose: its right side is already reduced to one row per key.
    """
    ahead = customer_day.select("customer_id", "order_date", "last_order_id", "next_day")
    next_date = F.when(F.col("order_id") < F.col("last_order_id"), F.col("order_date")).otherwise(
        F.col("next_day")
    )
    return (
        order_level.join(ahead, ["customer_id", "order_date"], "left")
        .withColumn("next_order_date", next_date)
        .withColumn("next_gap_days", F.datediff("next_order_date", "order_date"))
        .drop("last_order_id", "next_day")
    )


def repurchase_90d(order_level: DataFrame, days: int = 90) -> DataFrame:
    """Mark orders old enough to judge and, among them, those followed by another within the window."""
    # The latest date and the customer days are second, narrow reads: id, customer and date alone.
    latest = order_level.agg(F.max("order_date")).scalar()
    eligible = is_true(F.col("order_date") <= F.date_sub(latest, days))
    return (
        with_next_order(order_level, customer_days(order_level))
        .withColumn("eligible_90d", eligible)
        .withColumn("repurchase_90d", flag(F.col("eligible_90d") & F.col("next_gap_days").between(1, days)))
    )


def age_group_intensity(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, orders and orders per customer of each age group."""
    counts = orders.groupBy("customer_id").agg(F.count_distinct("order_id").alias("orders"))
    grouped = known(customers, "age_group").select("customer_id", "age_group")
    n = F.coalesce("orders", F.lit(0))
    return grouped.join(counts, "customer_id", "left").groupBy("age_group").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.sum(n).alias("total_orders"),
        F.avg(n).alias("avg_orders_per_customer"),
    )


def payment_status_share(orders: DataFrame) -> DataFrame:
    """Distinct orders per payment method and status, and the status's share of the method."""
    keys = ["payment_method", "order_status"]
    counted = known(orders, *keys).groupBy(*keys).agg(F.count_distinct("order_id").alias("orders"))
    return group_share(counted, "orders", "payment_method", "status_share", "total_orders")


def cancelled_share(orders: DataFrame) -> DataFrame:
    return payment_status_share(orders).where(F.col("order_status") == "cancelled")


# ---------------------------------------------------------------- lead times


def lead_time_counts(order_facts: DataFrame, upper: float = 0.995) -> DataFrame:
    """(delivery_lead_days, n) of non-negative lead times up to the given quantile.

    The quantile is taken over all lead times. Whole days repeat, so counting them first leaves a
    few thousand rows, which are kept for the statistics built on them.
    """
    counts = materialize(
        order_facts.where(F.col("delivery_lead_days").isNotNull())
        .groupBy("delivery_lead_days")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cut = counts.agg(F.percentile("delivery_lead_days", F.lit(upper), F.col("n"))).scalar()
    return counts.where((F.col("delivery_lead_days") >= 0) & (F.col("delivery_lead_days") <= cut))


def lead_time_stats(order_facts: DataFrame) -> DataFrame:
    """Count, mean, deviation, quartiles and range of the trimmed lead times."""
    counts = lead_time_counts(order_facts)
    days, n = F.col("delivery_lead_days"), F.col("n")

    def quantile(p: float) -> Column:
        return F.percentile(days, F.lit(p), n)

    mean = counts.agg(safe_divide(F.sum(days * n), F.sum(n))).scalar()
    squares = F.sum(F.pow(days - mean, F.lit(2.0)) * n)
    return counts.agg(
        F.sum(n).alias("count"),
        safe_divide(F.sum(days * n), F.sum(n)).alias("mean"),
        F.sqrt(safe_divide(squares, F.sum(n) - 1)).alias("std"),
        F.min(days).cast("double").alias("min"),
        quantile(0.25).alias("p25"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("p75"),
        F.max(days).cast("double").alias("max"),
    )


def lead_time_histogram(order_facts: DataFrame, bins: int = 30) -> DataFrame:
    return equal_width_bins(lead_time_counts(order_facts), "delivery_lead_days", bins)
