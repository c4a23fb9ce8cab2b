"""The six business answers as KPI frames, and the metric files built from them.

A1 revenue regimes, A2 customer health, A3 promotions, A4 conversion, A5 SKU actions, A6 recovery
scenarios. Each answer is one row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators import customers, products, promotions, revenue, traffic
from martflow.sources.raw import item_level, order_level
from martflow.sources.writers import save_metrics


@dataclass(frozen=True)
class Periods:
    """First year, last year before the break, last year; and scenario targets."""

    first: int = 2013
    split: int = 2018
    last: int = 2022

    @property
    def years(self) -> tuple[int, int, int]:
        return self.first, self.split, self.last

    @property
    def recent(self) -> tuple[int, int]:
        return self.split + 1, self.last


SCENARIO_TARGETS = {"conversion_30": 980e6, "cr_retention": 1085e6}


def a1_regime(t: dict[str, DataFrame], p: Periods) -> DataFrame:
    shift = revenue.regime_shift(t["sales"], *p.years)
    odd_august = revenue.negative_margin_months(t["sales"], *p.years).agg(
        F.count_if("is_odd_august").alias("negative_odd_augusts")
    )
    return shift.withColumn("negative_odd_augusts", odd_august.scalar())


def a2_customers(t: dict[str, DataFrame], p: Periods) -> DataFrame:
    return customers.customer_health_shift(order_level(t["orders"], t["payments"]), *p.years)


def a3_promotions(t: dict[str, DataFrame], p: Periods) -> DataFrame:
    items = item_level(t["order_items"], t["orders"], t["products"])
    return promotions.promo_gaps(promotions.promo_effect(items, *p.recent))


def a4_conversion(t: dict[str, DataFrame], p: Periods) -> DataFrame:
    return traffic.funnel_shift(t["web_traffic"], order_level(t["orders"], t["payments"]), *p.years)


def a5_sku_actions(t: dict[str, DataFrame], p: Periods) -> DataFrame:
    items = item_level(t["order_items"], t["orders"], t["products"])
    buckets = products.sku_bucket_summary(products.sku_buckets(t["inventory"], items, *p.recent))

    def count(label: str):
        return F.coalesce(F.max(F.when(F.col("action_bucket") == label, F.col("sku_count"))), F.lit(0))

    return buckets.agg(
        count(products.BUCKET_REFILL).alias("refill_sku_count"),
        count(products.BUCKET_CLEAR).alias("clear_sku_count"),
        F.max_by("action_bucket", "avg_monthly_revenue").alias("top_bucket"),
        F.max("avg_monthly_revenue_mn").alias("top_bucket_monthly_revenue_mn"),
    )


def a6_scenarios(forecast: DataFrame, start: str, end: str, targets: dict[str, float] = SCENARIO_TARGETS) -> DataFrame:
    """Totals and lift of the scenarios over the forecast days from ``start`` up to ``end``."""
    day = F.col("Date").cast("date")
    window = forecast.where((day >= F.to_date(F.lit(start))) & (day < F.to_date(F.lit(end))))
    lifts = revenue.scenario_lift(revenue.month_totals(window.withColumn("Date", day)), targets)

    def pick(name: str, column: str):
        return F.max(F.when(F.col("scenario") == name, F.col(column)))

    columns = [F.max("status_quo_mn").alias("status_quo_mn")]
    for name in targets:
        columns += [pick(name, c).alias(f"{name}_{c}") for c in ("target_mn", "lift_mn", "lift_pct")]
    return lifts.agg(*columns)


def combine(answers: dict[str, DataFrame]) -> DataFrame:
    """One row with every answer's KPIs, prefixed by the answer's name; each answer is one row."""
    spark = next(iter(answers.values())).sparkSession
    frame = spark.range(1).select()
    structs = {
        name: df.select(F.struct(*[F.col(c).alias(f"{name}_{c}") for c in df.columns])).scalar()
        for name, df in answers.items()
    }
    frame = reduce(lambda out, item: out.withColumn(item[0], item[1]), structs.items(), frame)
    return frame.select(*[f"{name}.*" for name in structs])


def write_story_metrics(
    t: dict[str, DataFrame], forecast: DataFrame, path: str, p: Periods = Periods(),
    scenario_days: tuple[str, str] = ("2024-01-01", "2024-07-01"),
) -> str:
    """The published set of answers: conversion, promotions, scenarios."""
    answers = {"a4": a4_conversion(t, p), "a3": a3_promotions(t, p), "a6": a6_scenarios(forecast, *scenario_days)}
    return save_metrics(combine(answers), path)


def write_patch_metrics(t: dict[str, DataFrame], path: str, p: Periods = Periods()) -> str:
    return save_metrics(combine({"a1": a1_regime(t, p), "a3": a3_promotions(t, p)}), path)
