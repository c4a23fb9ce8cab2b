"""Daily revenue and cost forecast: features, regime models, blend, margin, corrections, submission.

Two variants share every step but the features and the correction windows: ``slots`` finds its
windows in the data (33 features), ``holidays`` uses a fixed calendar (39 features).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.ordering import materialize
from martflow.operators import features, forecast, models, quality
from martflow.plans.answers import Periods
from martflow.session import build_session
from martflow.sources.raw import load_raw_data
from martflow.sources.writers import save_csv, save_submission, submission_rows

VARIANTS = ("slots", "holidays")


def feature_frame(t: dict[str, DataFrame], variant: str, p: Periods) -> tuple[DataFrame, list[str]]:
    aux = features.aux_slots(t["inventory"], t["web_traffic"], t["returns"], t["shipments"])
    if variant == "slots":
        frame = features.forecast_features(t["sales"], t["sample_submission"], aux, p.split + 1)
        return frame, features.FORECAST_FEATURES
    frame = features.holiday_forecast_features(t["sales"], t["sample_submission"], aux)
    return frame, features.HOLIDAY_FEATURES


def forecast_days(
    t: dict[str, DataFrame],
    variant: str = "slots",
    p: Periods = Periods(),
    size: models.EnsembleSize = models.EnsembleSize(),
    w: forecast.ForecastWeights = forecast.WEIGHTS,
) -> DataFrame:
    """(Date, Revenue, COGS) of every sample day after all corrections."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    # Daily sales feed many slot tables; they are computed once.
    t = {**t, "sales": materialize(t["sales"].select("Date", "Revenue", "COGS"))}
    frame, columns = feature_frame(t, variant, p)
    frame = materialize(frame)
    revenue = forecast.seasonal_blend(models.regime_predictions(frame, *p.years, size, columns), w)
    margins = models.margin_predictions(frame, *p.years, size, w, columns)
    days = forecast.margin_cogs(revenue.select("Date", "Revenue").join(margins, "Date"), w)
    days = days.select("Date", "Revenue", "COGS")
    correct = forecast.cogs_corrections if variant == "slots" else forecast.cogs_corrections_fixed
    return correct(days, t["sales"], p.split + 1, w).select("Date", "Revenue", "COGS")


def require_valid(submission: DataFrame, sample: DataFrame) -> None:
    """Fail unless the submission keeps its contract; the check is one row."""
    row = quality.submission_check(submission, sample).first()
    if row["status"] != "PASS":
        raise ValueError(f"invalid submission: {row.asDict()}")


def rolling_backtest(
    sales: DataFrame,
    n_splits: int = 3,
    valid_days: int = 90,
    w: forecast.ForecastWeights = forecast.WEIGHTS,
) -> DataFrame:
    """MAE, RMSE and R2 per fold of the seasonal profiles and the naive baselines.

    Profiles and baselines are rebuilt from each fold's own training days, so no validation day
    leaks into its own features.
    """
    daily = materialize(sales.select("Date", "Revenue"))
    folds = materialize(forecast.rolling_origin(daily, "Date", n_splits, valid_days))
    total = w.doy + w.month_dow + w.month_day
    scored = []
    for fold in range(1, n_splits + 1):
        rows = folds.where(F.col("fold") == fold)
        train, valid = rows.where(F.col("role") == "train"), rows.where(F.col("role") == "valid")
        actual = valid.select("fold", "Date", F.col("Revenue").alias("actual"))
        days = features.apply_profiles(
            features.add_forecast_calendar(valid.select("Date")), features.seasonal_profiles(train)
        )
        candidates = {
            "seasonal_profiles": days.select("Date", (forecast.seasonal_part(w) / total).alias("pred")),
            "seasonal_naive": forecast.seasonal_naive(train, valid).withColumnRenamed("Revenue", "pred"),
            "moving_average": forecast.moving_average(train, valid).withColumnRenamed("Revenue", "pred"),
        }
        scored += [actual.join(df, "Date").withColumn("model", F.lit(name)) for name, df in candidates.items()]
    return forecast.regression_report(quality.union_all(scored), by=("model", "fold"))


def run(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    variant: str = "slots",
    size: models.EnsembleSize = models.EnsembleSize(),
    p: Periods = Periods(),
) -> str:
    t = load_raw_data(
        spark, data_dir, ["sales", "sample_submission", "inventory", "web_traffic", "returns", "shipments"]
    )
    days = materialize(forecast_days(t, variant, p, size))
    submission = forecast.make_submission(days, t["sample_submission"])
    require_valid(submission_rows(submission), t["sample_submission"])
    path = save_submission(submission, f"{out_dir}/submission")
    frame, columns = feature_frame(t, variant, p)
    before, _, _ = models.regime_frames(frame, *p.years)
    importance = materialize(models.feature_importance(before, size, columns))
    save_csv(importance, f"{out_dir}/feature_importance")
    save_csv(models.grouped_importance(importance), f"{out_dir}/feature_group_importance")
    return path


def main() -> None:
    parser = argparse.ArgumentParser(description="Forecast daily revenue and cost and write a submission.")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--out-dir", required=True)
    parser.add_argument("--variant", choices=VARIANTS, default="slots")
    args = parser.parse_args()
    run(build_session("martflow-forecast"), args.data_dir, args.out_dir, args.variant)


if __name__ == "__main__":
    main()
