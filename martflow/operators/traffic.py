"""Traffic and place answers: sources, conversion funnel, regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.expr import in_years, period_label, safe_divide, sum_or_zero
from martflow.operators.customers import sold_orders
from martflow.operators.revenue import compare_periods


def traffic_source_quality(web_traffic: DataFrame) -> DataFrame:
    """Sessions, visitors, views and mean rates per traffic source."""
    return (
        web_traffic.where(F.col("traffic_source").isNotNull())
        .groupBy("traffic_source")
        .agg(
            F.sum("sessions").alias("sessions"),
            F.sum("unique_visitors").alias("unique_visitors"),
            F.sum("page_views").alias("page_views"),
            F.avg("bounce_rate").alias("avg_bounce_rate"),
            F.avg("avg_session_duration_sec").alias("avg_session_duration_sec"),
        )
        .orderBy(F.desc("sessions"))
    )


def conversion_funnel(
    web_traffic: DataFrame, order_level: DataFrame, first: int, split: int, last: int
) -> DataFrame:
    """Sessions, orders, revenue, conversion and revenue per session of each year with both."""
    sessions = (
        web_traffic.where(in_years("date", first, last))
        .groupBy(F.year("date").alias("year"))
        .agg(F.sum("sessions").alias("sessions"))
    )
    sold = (
        sold_orders(order_level, first, last)
        .groupBy(F.year("order_date").alias("year"))
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("payment_value").alias("revenue"))
    )
    return sessions.join(sold, "year").withColumns(
        {
            "conversion_rate": safe_divide("orders", "sessions"),
            "revenue_per_session": safe_divide("revenue", "sessions"),
            "period": period_label("year", split),
        }
    )


def funnel_shift(web_traffic: DataFrame, order_level: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Percent change of mean yearly sessions, conversion and revenue per session."""
    measures = ["sessions", "conversion_rate", "revenue_per_session"]
    mean_year = (
        conversion_funnel(web_traffic, order_level, first, split, last)
        .groupBy("period")
        .agg(*[F.avg(m).alias(m) for m in measures])
    )
    return compare_periods(mean_year, {f"{m}_change_pct": (m, "pct") for m in measures})


def region_revenue(lines: DataFrame) -> DataFrame:
    """Revenue, orders, units and revenue share per region."""
    summed = (
        lines.where(F.col("region").isNotNull())
        .groupBy("region")
        .agg(
            sum_or_zero("line_revenue").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            sum_or_zero("quantity").alias("units"),
        )
    )
    share = safe_divide(F.col("revenue"), F.sum("revenue").over(Window.partitionBy()))
    return summed.withColumn("revenue_share", share)
