from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martflow.functions.calendar import add_forecast_calendar
from martflow.operators import features, forecast, models

QUICK = models.EnsembleSize(boosted_rounds=4, forest_trees=6, depth=4, step=0.4, seeds=(42, 7), threads=2)


@pytest.fixture(scope="module")
def seasonal_sales(spark):
    """Three years with a strong yearly wave."""
    start = date(2018, 1, 1)
    rows = []
    for i in range(3 * 365):
        day = start + timedelta(i)
        revenue = 1000.0 + 800.0 * math.sin(2 * math.pi * day.timetuple().tm_yday / 365.25)
        rows.append((day, revenue, revenue * (0.7 + 0.1 * (day.month % 3))))
    return spark.createDataFrame(rows, "Date date, Revenue double, COGS double").coalesce(2).cache()


def test_preprocessing_fills_and_ignores_unseen_categories(spark):
    train = spark.createDataFrame(
        [(1.0, "a"), (3.0, "a"), (None, "b"), (9.0, None)], "x double, c string"
    )
    test = spark.createDataFrame([(None, "new"), (2.0, None)], "x double, c string")
    prep = models.fit_preprocessing(train, ["x", "c"])
    assert prep.numeric == ["x"] and prep.categorical == ["c"] and prep.fill == {"c": "a"}
    vectors = [r["features"].toArray().tolist() for r in prep.transform(test).collect()]
    assert vectors == [[3.0, 0.0, 0.0], [2.0, 1.0, 0.0]]  # median 3; unseen is all zero; missing is "a"


def test_single_model_beats_the_trailing_mean(seasonal_sales):
    days = features.add_lag_features(add_forecast_calendar(seasonal_sales), lags=(1, 7))
    train, valid = forecast.train_valid_frames(days, "Date", "2020-01-01")
    learner = models.build_learner("gbt", "label").setMaxIter(8)
    model, report, predictions = models.train_and_evaluate(train, valid, learner=learner)
    actual = predictions.select("Date", "actual")
    flat = forecast.moving_average(train, valid).withColumnRenamed("Revenue", "pred")
    naive = forecast.regression_report(actual.join(flat, "Date")).first()
    got = report.first()
    assert predictions.count() == 365 and got["MAE"] < naive["MAE"] / 2 and got["R2"] > 0.8
    assert models.build_learner("random_forest", "y").getNumTrees() == 300


def test_ensemble_is_repeatable_and_covers_every_day(seasonal_sales):
    train = add_forecast_calendar(seasonal_sales.where("Date < '2020-01-01'"))
    test = add_forecast_calendar(seasonal_sales.where("Date >= '2020-01-01'"))
    columns = features.CALENDAR_COLUMNS + features.CYCLIC_COLUMNS

    def predict():
        out = models.ensemble_predict(train, test, models.three_learners(QUICK), QUICK, features=columns)
        return {r["Date"]: round(r["prediction"], 6) for r in out.collect()}

    first = predict()
    assert len(first) == 365 and first == predict()
    truth = {r["Date"]: r["Revenue"] for r in test.collect()}
    error = sum(abs(first[d] - truth[d]) for d in truth) / len(truth)
    assert error < 250


def naive_boosted(rows, features, rounds, step):
    """Trees (feature, bound, below, above) of boosted stumps by exhaustive search, and predict() of them."""
    trees, so_far, goal = [], [0.0] * len(rows), [r["Revenue"] for r in rows]
    for k in range(rounds):
        best = None
        for f in features:
            for bound in sorted({r[f] for r in rows})[:-1]:
                low = [g for r, g in zip(rows, goal) if r[f] <= bound]
                high = [g for r, g in zip(rows, goal) if r[f] > bound]
                score = sum(low) ** 2 / len(low) + sum(high) ** 2 / len(high)
                if best is None or score > best[0]:
                    best = (score, f, bound, sum(low) / len(low), sum(high) / len(high))
        trees.append((1.0 if k == 0 else step, *best[1:]))
        so_far = [s + trees[-1][0] * (best[3] if r[best[1]] <= best[2] else best[4]) for s, r in zip(so_far, rows)]
        goal = [2 * (r["Revenue"] - s) for r, s in zip(rows, so_far)]
    return lambda r: sum(w * (low if r[f] <= bound else high) for w, f, bound, low, high in trees)


def test_stumps_and_permutation_importance_equal_plain_python(spark):
    rng = random.Random(8)
    start = date(2019, 1, 1)
    rows = [{"Date": start + timedelta(k), "a": rng.randint(1, 12), "b": rng.randint(0, 6), "c": rng.randint(0, 2)} for k in range(400)]
    for r in rows:
        r["Revenue"] = 100.0 * (r["a"] > 5) + 30.0 * (r["b"] > 2) + rng.random()
    days = spark.createDataFrame([(r["Date"], r["Revenue"], r["a"], r["b"], r["c"]) for r in rows], "Date date, Revenue double, a int, b int, c int")
    train, valid = days.where("Date < '2019-10-01'"), days.where("Date >= '2019-10-01'")
    known, new = ([r for r in rows if (r["Date"] < date(2019, 10, 1)) == is_train] for is_train in (True, False))
    single = models.fit_single(train, learner=models.stump_booster(rounds=4, step=0.3))
    predict = naive_boosted(known, "abc", 4, 0.3)
    found = {r["Date"]: r["pred"] for r in single.predict(valid).collect()}
    assert found == pytest.approx({r["Date"]: predict(r) for r in new})
    plain = sum(abs(r["Revenue"] - predict(r)) for r in new) / len(new)
    expected = {}
    for f in "abc":
        # each day takes the value of the day 7 places later
        moved = [{**r, f: new[(k + 7) % len(new)][f]} for k, r in enumerate(new)]
        expected[f] = sum(abs(r["Revenue"] - predict(r)) for r in moved) / len(new)
    got = {r["feature"]: r for r in models.permutation_importance(single, valid, shift=7).collect()}
    assert {f: r["MAE"] for f, r in got.items()} == pytest.approx(expected)
    assert {f: r["increase"] for f, r in got.items()} == pytest.approx({f: e - plain for f, e in expected.items()}, abs=1e-9)
    assert got["a"]["increase"] > got["b"]["increase"] > abs(got["c"]["increase"])


def test_boosting_ends_when_held_out_days_stop_gaining(spark, seasonal_sales):
    train = add_forecast_calendar(seasonal_sales.where("Date < '2020-01-01'"))
    columns = features.CALENDAR_COLUMNS + features.CYCLIC_COLUMNS
    size = models.EnsembleSize(boosted_rounds=400, forest_trees=3, depth=3, step=0.5, seeds=(42, 7), threads=2)
    ensemble = models.fit_ensemble(train, models.three_learners(size), size, features=columns)
    used = {(r["learner"], r["seed"]): r["trees"] for r in ensemble.rounds(spark).collect()}
    assert set(used) == {(k, s) for k in range(3) for s in (42, 7)} and used[2, 42] == 3
    assert all(1 < used[k, s] < 100 for k in (0, 1) for s in (42, 7))
    held = models._with_held_out(train, size).agg(F.avg(F.col("held_42").cast("int")), F.avg(F.col("held_7").cast("int")), F.avg((F.col("held_7") & F.col("held_42")).cast("int"))).first()
    assert 0.05 < held[0] < 0.15 and 0.05 < held[1] < 0.15 and held[2] < 0.05


def test_importance_lists_every_feature(seasonal_sales):
    train = add_forecast_calendar(seasonal_sales)
    columns = features.CALENDAR_COLUMNS + features.CYCLIC_COLUMNS
    importance = models.feature_importance(train, QUICK, columns)
    rows = importance.collect()
    assert sorted(r["feature"] for r in rows) == sorted(columns)
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    groups = {r["feature_group"]: r["importance"] for r in models.grouped_importance(importance).collect()}
    assert set(groups) == {"Calendar basics", "Fourier"}


def test_feature_lists_have_the_published_sizes():
    assert len(features.FORECAST_FEATURES) == len(set(features.FORECAST_FEATURES)) == 33
    assert len(features.HOLIDAY_FEATURES) == len(set(features.HOLIDAY_FEATURES)) == 39


def test_preprocessing_takes_booleans_as_numbers_and_exact_medians(spark):
    rows = [(float(i), i % 3 == 0, "x") for i in range(1001)] + [(None, None, None)]
    prep = models.fit_preprocessing(spark.createDataFrame(rows, "v double, b boolean, c string"), ["v", "b", "c"])
    assert prep.numeric == ["v", "b"] and prep.medians == {"v": 500.0, "b": 0.0}


def test_too_many_categories_raise(spark, monkeypatch):
    monkeypatch.setattr(models, "MAX_CATEGORIES", 2)
    with pytest.raises(ValueError, match="categories"):
        models.fit_preprocessing(spark.createDataFrame([("a",), ("b",), ("c",)], "c string"), ["c"])
