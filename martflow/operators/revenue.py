"""Revenue answers: KPIs, months, seasonality, regimes, anomalies, scenarios.

Inputs named ``sales`` or ``daily`` have one row per calendar day (Date, Revenue, COGS). Windows
without a partition key appear only on such frames and on their monthly sums, whose size is set by
the calendar, not by the amount of data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.calendar import month_key, month_start
from martflow.functions.expr import (
    in_years,
    known,
    pct_change,
    period_label,
    point_change,
    safe_divide,
    sum_or_zero,
)

REVENUE_UNIT = 1e6


def margin(revenue: Column | str, cogs: Column | str) -> Column:
    revenue = F.col(revenue) if isinstance(revenue, str) else revenue
    cogs = F.col(cogs) if isinstance(cogs, str) else cogs
    return safe_divide(revenue - cogs, revenue)


def revenue_kpis(daily: DataFrame) -> DataFrame:
    totals = daily.agg(
        F.sum("Revenue").alias("total_revenue"),
        F.sum("COGS").alias("total_cogs"),
        F.min("Date").alias("start_date"),
        F.max("Date").alias("end_date"),
    )
    return totals.select(
        "total_revenue",
        "total_cogs",
        (F.col("total_revenue") - F.col("total_cogs")).alias("gross_profit"),
        margin("total_revenue", "total_cogs").alias("gross_margin_pct"),
        "start_date",
        "end_date",
    )


def portfolio_counts(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Number of order lines and of distinct products, one row."""
    listed = products.agg(F.count_distinct("product_id")).scalar()
    return lines.agg(F.count(F.lit(1)).alias("n_item_lines")).withColumn("n_products", listed)


def monthly_revenue(daily: DataFrame) -> DataFrame:
    """Revenue, cost, mean daily revenue, days and margin per month that occurs."""
    return known(daily, "Date").groupBy(month_key("Date").alias("year_month")).agg(
        F.sum("Revenue").alias("revenue"),
        F.sum("COGS").alias("cogs"),
        F.avg("Revenue").alias("avg_daily_revenue"),
        F.count(F.lit(1)).alias("n_days"),
    ).withColumn("gross_margin", margin("revenue", "cogs"))


def monthly_resample(daily: DataFrame) -> DataFrame:
    """Every month between the first and the last, empty ones with 0, and 3-month means."""
    sums = daily.groupBy(F.last_day("Date").alias("month_end")).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("COGS").alias("COGS")
    )
    months = daily.agg(
        F.explode(
            F.sequence(month_start(F.min("Date")), month_start(F.max("Date")), F.expr("interval 1 month"))
        ).alias("first_day")
    ).select(F.last_day("first_day").alias("month_end"))
    filled = months.join(sums, "month_end", "left").withColumns(
        {"Revenue": F.coalesce("Revenue", F.lit(0.0)), "COGS": F.coalesce("COGS", F.lit(0.0))}
    )
    last_three = Window.orderBy("month_end").rowsBetween(-2, 0)
    return filled.withColumn("gross_margin", margin("Revenue", "COGS")).withColumns(
        {
            "revenue_3m_avg": F.avg("Revenue").over(last_three),
            "margin_3m_avg": F.avg("gross_margin").over(last_three),
        }
    )


def seasonality(daily: DataFrame) -> DataFrame:
    """Mean daily revenue and margin per calendar month."""
    day_margin = F.when(F.col("Revenue") > 0, margin("Revenue", "COGS"))
    return known(daily, "Date").groupBy(F.month("Date").alias("month")).agg(
        F.avg("Revenue").alias("avg_daily_revenue"),
        F.avg(day_margin).alias("avg_margin"),
        F.count("Date").alias("days"),
    )


def annual_mean_revenue(daily: DataFrame) -> DataFrame:
    return known(daily, "Date").groupBy(F.year("Date").alias("year")).agg(F.avg("Revenue").alias("avg_daily_revenue"))


def regime_months(daily: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Months inside the compared years with their margin and period."""
    months = (
        daily.where(in_years("Date", first, last))
        .groupBy(month_start("Date").alias("month_start"))
        .agg(
            F.sum("Revenue").alias("revenue"),
            F.sum("COGS").alias("cogs"),
            F.count(F.lit(1)).alias("n_days"),
        )
    )
    return months.withColumns(
        {
            "gross_margin": margin("revenue", "cogs"),
            "year": F.year("month_start"),
            "month": F.month("month_start"),
            "period": period_label(F.year("month_start"), split),
        }
    )


def regime_summary(daily: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Totals, means, best month and worst margin month before and after the split year."""
    months = regime_months(daily, first, split, last)
    # Of equal months the earliest counts, so the ordering value carries the date.
    best = F.struct(F.col("revenue"), (-F.unix_date("month_start")).alias("k"))
    worst = F.struct(F.col("gross_margin"), F.unix_date("month_start").alias("k"))
    return months.groupBy("period").agg(
        F.sum("revenue").alias("total_revenue"),
        safe_divide(F.sum("revenue"), F.sum("n_days")).alias("avg_daily_revenue"),
        F.avg("revenue").alias("avg_monthly_revenue"),
        F.max("revenue").alias("peak_month_revenue"),
        F.date_format(F.max_by("month_start", best), "yyyy-MM").alias("peak_month"),
        margin(F.sum("revenue"), F.sum("cogs")).alias("weighted_gross_margin"),
        F.min("gross_margin").alias("worst_gross_margin"),
        F.date_format(
            F.min_by("month_start", F.when(F.col("gross_margin").isNotNull(), worst)), "yyyy-MM"
        ).alias("worst_margin_month"),
    )


def _by_period(name: str, period: str) -> Column:
    return F.max(F.when(F.col("period") == period, F.col(name)))


def compare_periods(summary: DataFrame, changes: dict[str, tuple[str, str]]) -> DataFrame:
    """One row of before/after changes. Each entry is name -> (column, "pct" or "points")."""
    columns = []
    for name, (column, kind) in changes.items():
        before, after = _by_period(column, "pre"), _by_period(column, "post")
        change = pct_change(after, before) if kind == "pct" else point_change(after, before)
        columns.append(change.alias(name))
    return summary.agg(*columns)


def regime_shift(daily: DataFrame, first: int, split: int, last: int) -> DataFrame:
    """Change of daily, monthly and peak revenue (percent) and of margin (points)."""
    return compare_periods(
        regime_summary(daily, first, split, last),
        {
            "avg_daily_change_pct": ("avg_daily_revenue", "pct"),
            "avg_monthly_change_pct": ("avg_monthly_revenue", "pct"),
            "peak_change_pct": ("peak_month_revenue", "pct"),
            "gross_margin_change_pp": ("weighted_gross_margin", "points"),
        },
    )


def negative_margin_months(daily: DataFrame, first: int, split: int, last: int, below: float = 0.0) -> DataFrame:
    """Months sold below the given margin, marked when they are an August of an odd year."""
    months = regime_months(daily, first, split, last).where(F.col("gross_margin") < below)
    odd_august = (F.col("month") == 8) & (F.col("year") % 2 == 1)
    return months.select(
        month_key("month_start").alias("year_month"), "period", "revenue", "cogs", "gross_margin",
        odd_august.alias("is_odd_august"),
    )


def scored_revenue(daily: DataFrame, window: int = 28, min_days: int = 7, threshold: float = 3.0) -> DataFrame:
    """Every day with its trailing mean, deviation and z-score, and whether it is an anomaly."""
    trailing = Window.orderBy("Date").rowsBetween(-(window - 1), 0)
    enough = F.count("Revenue").over(trailing) >= min_days
    scored = daily.select(
        "Date",
        "Revenue",
        "COGS",
        F.when(enough, F.avg("Revenue").over(trailing)).alias("revenue_28d_mean"),
        F.when(enough, F.stddev_samp("Revenue").over(trailing)).alias("revenue_28d_std"),
    ).withColumn("z_score", safe_divide(F.col("Revenue") - F.col("revenue_28d_mean"), "revenue_28d_std"))
    return scored.withColumn("is_anomaly", F.coalesce(F.abs("z_score") >= threshold, F.lit(False)))


def top_anomalies(scored: DataFrame, top: int = 30) -> DataFrame:
    """The ``top`` anomalies of a scored series, strongest first."""
    strongest = scored.where("is_anomaly").orderBy(F.abs("z_score").desc(), "Date").limit(top)
    return strongest.drop("is_anomaly")


def scenario_scale(monthly: DataFrame, targets: dict[str, float], month_col: str = "month") -> DataFrame:
    """Scale a monthly baseline so that it sums to each scenario's target; amounts also in millions."""
    base = monthly.select(F.col(month_col).alias("month"), F.col("revenue").alias("status_quo"))
    total = F.sum("status_quo").over(Window.partitionBy())
    scaled = base.withColumns(
        {name: F.col("status_quo") * safe_divide(F.lit(float(t)), total) for name, t in targets.items()}
    )
    return scaled.withColumns({f"{c}_mn": F.col(c) / REVENUE_UNIT for c in ("status_quo", *targets)})


def scenario_lift(monthly: DataFrame, targets: dict[str, float]) -> DataFrame:
    """Total, lift and lift percent of each scenario against the baseline, in millions."""
    baseline = F.sum("revenue") / REVENUE_UNIT
    scenarios = F.array(
        *[
            F.struct(F.lit(n).alias("scenario"), F.lit(t / REVENUE_UNIT).alias("target_mn"))
            for n, t in targets.items()
        ]
    )
    return (
        monthly.agg(baseline.alias("status_quo_mn"))
        .select("status_quo_mn", F.explode(scenarios).alias("s"))
        .select("s.scenario", "status_quo_mn", "s.target_mn")
        .withColumn("lift_mn", F.col("target_mn") - F.col("status_quo_mn"))
        .withColumn("lift_pct", safe_divide("lift_mn", "status_quo_mn") * 100)
    )


def month_totals(daily: DataFrame) -> DataFrame:
    return known(daily, "Date").groupBy(month_start("Date").alias("month")).agg(sum_or_zero("Revenue").alias("revenue"))
