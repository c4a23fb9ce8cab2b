"""Splits, baselines, metrics, blends, cost corrections and the submission frame.

Everything here works on frames of calendar days and takes predictions as a DataFrame, so it does
not matter which model made them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.calendar import in_summer_blowout, in_year_end, slot
from martflow.functions.expr import clip, is_true, safe_divide
from martflow.operators.features import MONTH_DAY, slot_cost_ratios
from martflow.operators.joins import slot_lookup


@dataclass(frozen=True)
class ForecastWeights:
    """Blend weights, correction strengths, thresholds and fallback ratios."""

    model: float = 0.58
    doy: float = 0.02
    month_dow: float = 0.04
    month_day: float = 0.36
    regime_a: float = 0.54
    blowout_strength: float = 0.70
    year_end_strength: float = 0.50
    blowout_ratio: float = 1.0
    year_end_ratio: float = 0.92
    blowout_default: float = 0.85
    year_end_default: float = 0.95
    margin_low: float = 0.02
    margin_high: float = 0.35
    submission_cost_share: float = 0.85


WEIGHTS = ForecastWeights()


# ---------------------------------------------------------------- splits


def time_split(df: DataFrame, date_col: str = "Date", valid_start: str = "2022-01-01") -> DataFrame:
    """Label rows ``train`` before the start of validation and ``valid`` from it on."""
    day, start = F.col(date_col), F.to_date(F.lit(valid_start))
    return df.where(day.isNotNull()).withColumn("role", F.when(day < start, "train").otherwise("valid"))


def train_valid_frames(
    df: DataFrame, date_col: str = "Date", valid_start: str = "2022-01-01"
) -> tuple[DataFrame, DataFrame]:
    start = F.to_date(F.lit(valid_start))
    return df.where(F.col(date_col) < start), df.where(F.col(date_col) >= start)


def rolling_origin(df: DataFrame, date_col: str = "Date", n_splits: int = 3, valid_days: int = 90) -> DataFrame:
    """Rows of each fold with their role; a fold trains strictly before its validation days."""
    latest = df.agg(F.max(date_col)).scalar()
    valid_end = F.date_sub(latest, (F.lit(n_splits) - F.col("fold")) * valid_days)
    day = F.col(date_col)
    role = F.when(day < F.col("valid_start"), "train").when(day <= F.col("valid_end"), "valid")
    folds = F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold")
    return (
        df.select("*", folds)
        .withColumn("valid_end", valid_end)
        .withColumn("valid_start", F.date_sub("valid_end", valid_days - 1))
        .withColumn("role", role)
        .where(F.col("role").isNotNull())
    )


# ---------------------------------------------------------------- baselines


def trailing_mean(train: DataFrame, target_col: str, date_col: str, window: int) -> Column:
    """Mean of the last rows by date, as a scalar subquery."""
    last = train.orderBy(F.col(date_col).desc()).limit(window)
    return last.agg(F.avg(target_col)).scalar()


def seasonal_naive(
    train: DataFrame,
    future: DataFrame,
    target_col: str = "Revenue",
    date_col: str = "Date",
    lag_days: int = 365,
    window: int = 28,
) -> DataFrame:
    """Value of the same day ``lag_days`` earlier, or the mean of the last 28 days where unknown."""
    earlier = train.select(
        F.date_add(date_col, lag_days).alias(date_col), F.col(target_col).alias("_earlier"), F.lit(True).alias("_seen")
    )
    fallback = trailing_mean(train, target_col, date_col, window)
    value = F.when(F.col("_seen"), F.col("_earlier")).otherwise(fallback)
    return future.select(date_col).join(earlier, date_col, "left").select(date_col, value.alias(target_col))


def moving_average(
    train: DataFrame, future: DataFrame, target_col: str = "Revenue", window: int = 28, date_col: str = "Date"
) -> DataFrame:
    return future.select(date_col, trailing_mean(train, target_col, date_col, window).alias(target_col))


# ---------------------------------------------------------------- metrics


def regression_report(
    df: DataFrame, actual: str = "actual", predicted: str = "pred", by: tuple[str, ...] = ()
) -> DataFrame:
    """MAE, RMSE and R2 (0 for a constant target) in one aggregation, optionally per group."""
    error = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count(actual)
    r2 = F.when(spread > 0, 1 - F.sum(error * error) / spread).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"), r2.alias("R2")
    )


# ---------------------------------------------------------------- blending


def seasonal_part(w: ForecastWeights = WEIGHTS) -> Column:
    return (
        F.lit(w.doy) * F.col("rev_doy_median")
        + F.lit(w.month_dow) * F.col("rev_month_dow_mean")
        + F.lit(w.month_day) * F.col("rev_month_day_median")
    )


def regime_mix(a: Column, b: Column, w: ForecastWeights = WEIGHTS) -> Column:
    return F.lit(w.regime_a) * a + F.lit(1 - w.regime_a) * b


def seasonal_blend(days: DataFrame, w: ForecastWeights = WEIGHTS) -> DataFrame:
    """Revenue from two regime predictions and the seasonal profiles, never below 0.

    Expects pred_a, pred_b and the three profile columns.
    """
    seasonal = seasonal_part(w)
    final_a = F.lit(w.model) * F.col("pred_a") + seasonal
    final_b = F.lit(w.model) * F.col("pred_b") + seasonal
    return days.withColumns(
        {"final_a": final_a, "final_b": final_b, "Revenue": F.greatest(regime_mix(final_a, final_b, w), F.lit(0.0))}
    )


def day_margin(sales: DataFrame, w: ForecastWeights = WEIGHTS) -> DataFrame:
    """Daily margin bounded to the range the margin model may predict."""
    raw = safe_divide(F.col("Revenue") - F.col("COGS"), "Revenue")
    return sales.withColumn("Margin", clip(raw, w.margin_low, w.margin_high))


def margin_cogs(days: DataFrame, w: ForecastWeights = WEIGHTS) -> DataFrame:
    """Cost from predicted revenue and two regime margins (margin_a, margin_b)."""

    def bounded(c: Column) -> Column:
        return clip(c, w.margin_low, w.margin_high)

    margin = bounded(regime_mix(bounded(F.col("margin_a")), bounded(F.col("margin_b")), w))
    return days.withColumn("Margin", margin).withColumn("COGS", F.col("Revenue") * (1 - F.col("Margin")))


# ---------------------------------------------------------------- cost corrections


def is_blowout_slot(w: ForecastWeights = WEIGHTS) -> Column:
    return is_true(F.col("md_ratio_odd") > w.blowout_ratio)


def is_year_end_slot(w: ForecastWeights = WEIGHTS) -> Column:
    return is_true(F.col("md_ratio_post") > w.year_end_ratio) & ~is_blowout_slot(w)


def blowout_slots_by_month(sales: DataFrame, w: ForecastWeights = WEIGHTS) -> DataFrame:
    """Number of (month, day) slots sold below cost in odd years, per month."""
    return (
        slot_cost_ratios(sales).where(is_blowout_slot(w)).groupBy("Month").agg(F.count(F.lit(1)).alias("slots"))
    )


def year_end_slots(sales: DataFrame, post_from: int = 2019, w: ForecastWeights = WEIGHTS) -> DataFrame:
    """Slots with a high recent cost ratio that are not blowout slots."""
    return (
        slot_cost_ratios(sales, post_from).where(is_year_end_slot(w)).select("Month", "Day", "md_ratio_post")
    )


def _pull(cogs: Column, ratio: Column, strength: float) -> Column:
    return F.lit(1 - strength) * cogs + F.lit(strength) * F.col("Revenue") * ratio


def _corrected(days: DataFrame, blowout: Column, year_end: Column, w: ForecastWeights) -> DataFrame:
    """Pull the cost of the marked days towards revenue times the slot's historic cost ratio."""
    odd_ratio = F.coalesce("md_ratio_odd", F.lit(w.blowout_default))
    post_ratio = F.coalesce("md_ratio_post", F.lit(w.year_end_default))
    after_blowout = F.when(blowout, _pull(F.col("COGS"), odd_ratio, w.blowout_strength)).otherwise(F.col("COGS"))
    return (
        days.withColumns({"ub_window": blowout, "ye_window": year_end, "cogs_after_ub": after_blowout})
        .withColumn(
            "COGS",
            F.when(F.col("ye_window"), _pull(F.col("cogs_after_ub"), post_ratio, w.year_end_strength)).otherwise(
                F.col("cogs_after_ub")
            ),
        )
        .drop("Month", "Day", "md_ratio_odd", "md_ratio_even", "md_ratio_post")
    )


def _with_slot_ratios(forecast: DataFrame, sales: DataFrame, post_from: int) -> DataFrame:
    return slot_lookup(forecast.withColumns(slot("Date")), slot_cost_ratios(sales, post_from), MONTH_DAY)


def cogs_corrections(
    forecast: DataFrame, sales: DataFrame, post_from: int = 2019, w: ForecastWeights = WEIGHTS
) -> DataFrame:
    """Corrections on slots found in the data: blowout days of odd years, then year-end days."""
    days = _with_slot_ratios(forecast, sales, post_from)
    blowout = (F.year("Date") % 2 == 1) & is_blowout_slot(w)
    return _corrected(days, blowout, is_year_end_slot(w), w)


def cogs_corrections_fixed(
    forecast: DataFrame, sales: DataFrame, post_from: int = 2019, w: ForecastWeights = WEIGHTS
) -> DataFrame:
    """The same corrections on fixed calendar windows: 30 July to 2 September of odd years, then
    18 November to 31 December."""
    days = _with_slot_ratios(forecast, sales, post_from)
    month, day = F.col("Month"), F.col("Day")
    blowout = (F.year("Date") % 2 == 1) & in_summer_blowout(month, day)
    return _corrected(days, blowout, in_year_end(month, day) & ~blowout, w)


# ---------------------------------------------------------------- submission


def make_submission(
    predictions: DataFrame,
    sample: DataFrame,
    revenue_col: str = "Revenue",
    cogs_col: str = "COGS",
    w: ForecastWeights = WEIGHTS,
) -> DataFrame:
    """Predictions on the sample's dates; without a cost column, cost is a fixed share of revenue."""
    if revenue_col not in predictions.columns:
        raise ValueError(f"predictions have no column {revenue_col!r}")
    kept = [c for c in ("Date", revenue_col, cogs_col) if c in predictions.columns]
    aligned = sample.select("Date").join(predictions.select(*kept), "Date", "left")
    if cogs_col not in kept:
        aligned = aligned.withColumn(cogs_col, F.col(revenue_col) * w.submission_cost_share)
    return aligned.select("Date", revenue_col, cogs_col)
