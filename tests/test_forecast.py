from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martflow.functions.calendar import add_forecast_calendar
from martflow.operators import features, forecast
from tests.conftest import by_key

SALES = "Date date, Revenue double, COGS double"


def series(spark, values, start=date(2019, 1, 1), cost=0.8):
    return spark.createDataFrame([(start + timedelta(i), float(v), float(v) * cost) for i, v in enumerate(values)], SALES)


def test_lags_count_rows_not_days(spark):
    df = series(spark, range(40)).where("Date <> date'2019-01-05'")
    rows = sorted(features.add_lag_features(df).collect(), key=lambda r: r["Date"])
    want = pd.Series([r["Revenue"] for r in rows])
    for k in (1, 7, 14, 28):
        got = [r[f"Revenue_lag_{k}"] for r in rows]
        assert [g for g in got if g is not None] == want.shift(k).dropna().tolist()


def test_rolling_windows_need_all_rows(spark):
    values = np.random.default_rng(1).normal(100, 5, 35)
    rows = sorted(features.add_rolling_features(series(spark, values)).collect(), key=lambda r: r["Date"])
    shifted = pd.Series(values).shift(1)
    for w in (7, 14, 28):
        for name in ("mean", "std", "min", "max"):
            want = getattr(shifted.rolling(w), name)()
            got = pd.Series([r[f"Revenue_roll_{name}_{w}"] for r in rows], dtype=float)
            np.testing.assert_allclose(got, want)


def test_lags_stay_inside_a_series(spark):
    df = series(spark, [1, 2]).withColumn("shop", F.lit("a")).unionByName(series(spark, [7, 8]).withColumn("shop", F.lit("b")))
    rows = features.add_lag_features(df, lags=(1,), series=("shop",)).collect()
    assert sorted((r["shop"], r["Revenue_lag_1"]) for r in rows if r["Revenue_lag_1"] is not None) == [("a", 1.0), ("b", 7.0)]


def test_slot_tables(spark):
    rows = [(date(y, 1, d), 100.0 * d * (2 if y % 2 else 1), 90.0 * d * (3 if y % 2 else 1)) for y in (2017, 2018, 2019, 2020) for d in range(1, 12)]
    sales = spark.createDataFrame(rows, SALES)
    ratios = by_key(features.slot_cost_ratios(sales), "Month", "Day")
    assert ratios[1, 3]["md_ratio_odd"] == pytest.approx(1.35) and ratios[1, 3]["md_ratio_even"] == pytest.approx(0.9)
    assert ratios[1, 3]["md_ratio_post"] == pytest.approx((1.35 + 0.9) / 2)
    flags = by_key(features.slot_revenue_flags(sales), "Month", "Day")
    assert [d for (_, d), r in flags.items() if r["is_hi_rev_md"]] == [11]
    assert [d for (_, d), r in flags.items() if r["is_lo_rev_md"]] == [1]
    assert forecast.blowout_slots_by_month(sales).first()["slots"] == 11
    assert forecast.year_end_slots(sales).count() == 0  # every such slot is a blowout slot already


def test_profiles_fall_back_to_the_overall_median(spark):
    train = series(spark, range(1, 60), date(2019, 1, 1))
    days = add_forecast_calendar(spark.createDataFrame([(date(2020, 2, 29),), (date(2020, 12, 1),)], "Date date"))
    rows = by_key(features.apply_profiles(days, features.seasonal_profiles(train)), "Date")
    assert rows[date(2020, 2, 29)]["rev_month_day_median"] == 30.0
    assert rows[date(2020, 12, 1)]["rev_month_dow_mean"] == 30.0


def test_fill_with_mean_keeps_roles_apart(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 5.0), ("b", None)], "role string, x double")
    assert sorted((r["role"], r["x"]) for r in features.fill_with_mean(df, ["x"]).collect()) == [("a", 1.0), ("a", 1.0), ("b", 5.0), ("b", 5.0)]


def test_folds_match_their_definition(spark):
    df = series(spark, range(400))
    last = date(2019, 1, 1) + timedelta(399)
    rows = forecast.rolling_origin(df).toPandas()
    for fold, back in ((1, 180), (2, 90), (3, 0)):
        end = last - timedelta(back)
        start = end - timedelta(89)
        part = rows[rows["fold"] == fold]
        valid, train = part[part["role"] == "valid"]["Date"], part[part["role"] == "train"]["Date"]
        assert (valid.min(), valid.max(), len(valid)) == (start, end, 90)
        assert train.max() == start - timedelta(1) and train.min() == date(2019, 1, 1)


def test_split_and_baselines(spark):
    df = series(spark, range(400))
    train, valid = forecast.train_valid_frames(df, "Date", "2020-01-01")
    assert (train.count(), valid.count()) == (365, 35)
    labelled = forecast.time_split(df, "Date", "2020-01-01").groupBy("role").count().collect()
    assert {r["role"]: r["count"] for r in labelled} == {"train": 365, "valid": 35}
    future = spark.createDataFrame([(date(2020, 1, 1),), (date(2025, 1, 1),)], "Date date")
    naive = by_key(forecast.seasonal_naive(train, future), "Date")
    fallback = float(np.mean(range(337, 365)))
    assert naive[date(2020, 1, 1)]["Revenue"] == 0.0 and naive[date(2025, 1, 1)]["Revenue"] == fallback
    assert {r["Revenue"] for r in forecast.moving_average(train, future).collect()} == {fallback}


def test_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "actual double, pred double")
    row = forecast.regression_report(df).first()
    assert row["MAE"] == pytest.approx(np.abs(y - p).mean()) and row["RMSE"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert row["R2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert forecast.regression_report(spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "actual double, pred double")).first()["R2"] == 0.0


def test_blend_is_never_negative(spark):
    df = spark.createDataFrame([(-1000.0, -1000.0, 1.0, 1.0, 1.0), (100.0, 200.0, 10.0, 20.0, 30.0)], "pred_a double, pred_b double, rev_doy_median double, rev_month_dow_mean double, rev_month_day_median double")
    rows = [r["Revenue"] for r in forecast.seasonal_blend(df).collect()]
    seasonal = 0.02 * 10 + 0.04 * 20 + 0.36 * 30
    assert rows[0] == 0.0 and rows[1] == pytest.approx(0.54 * (58 + seasonal) + 0.46 * (116 + seasonal))


def test_margins_are_bounded(spark):
    df = spark.createDataFrame([(100.0, 0.9, -3.0)], "Revenue double, margin_a double, margin_b double")
    row = forecast.margin_cogs(df).first()
    margin = 0.54 * 0.35 + 0.46 * 0.02
    assert row["Margin"] == pytest.approx(margin) and row["COGS"] == pytest.approx(100 * (1 - margin))


def test_corrections_first_window_wins(spark):
    # 5 Jan: ratio above 1 in odd years and above 0.92 since 2019, so only the blowout pull applies.
    history = [(date(2019, 1, 5), 100.0, 130.0), (date(2020, 1, 5), 100.0, 100.0), (date(2019, 1, 6), 100.0, 95.0), (date(2020, 1, 7), 100.0, 50.0)]
    sales = spark.createDataFrame(history, SALES)
    plan = spark.createDataFrame(
        [(date(2021, 1, 5), 200.0, 150.0), (date(2022, 1, 5), 200.0, 150.0), (date(2022, 1, 6), 200.0, 150.0), (date(2022, 1, 8), 200.0, 150.0)], SALES
    )
    rows = by_key(forecast.cogs_corrections(plan, sales), "Date")
    assert rows[date(2021, 1, 5)]["COGS"] == pytest.approx(0.3 * 150 + 0.7 * 200 * 1.3)
    assert rows[date(2022, 1, 5)]["COGS"] == 150.0  # even year, and not a year-end slot
    assert rows[date(2022, 1, 6)]["COGS"] == pytest.approx(0.5 * 150 + 0.5 * 200 * 0.95)
    assert rows[date(2022, 1, 8)]["COGS"] == 150.0


def test_fixed_corrections_use_default_ratios(spark):
    sales = spark.createDataFrame([(date(2019, 3, 1), 100.0, 70.0)], SALES)
    plan = spark.createDataFrame([(date(2021, 8, 1), 100.0, 60.0), (date(2021, 12, 24), 100.0, 60.0), (date(2022, 8, 1), 100.0, 60.0)], SALES)
    rows = by_key(forecast.cogs_corrections_fixed(plan, sales), "Date")
    assert rows[date(2021, 8, 1)]["COGS"] == pytest.approx(0.3 * 60 + 0.7 * 100 * 0.85)
    assert rows[date(2021, 12, 24)]["COGS"] == pytest.approx(0.5 * 60 + 0.5 * 100 * 0.95)
    assert rows[date(2022, 8, 1)]["COGS"] == 60.0


def test_submission_frame(spark):
    sample = spark.createDataFrame([(date(2023, 1, 1),), (date(2023, 1, 2),)], "Date date")
    predicted = spark.createDataFrame([(date(2023, 1, 1), 100.0)], "Date date, Revenue double")
    rows = by_key(forecast.make_submission(predicted, sample), "Date")
    assert rows[date(2023, 1, 1)]["COGS"] == 85.0 and rows[date(2023, 1, 2)]["Revenue"] is None
    with pytest.raises(ValueError, match="no column 'Revenue'"):
        forecast.make_submission(predicted.withColumnRenamed("Revenue", "x"), sample)
