from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from martflow.functions import expr
from martflow.functions.calendar import LUNAR_NEW_YEAR, add_calendar_features, add_holiday_features, days_to_holiday


def test_safe_divide_and_clip(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    rows = df.select(
        expr.safe_divide("a", "b").alias("q"),
        expr.safe_divide("a", "b", 9.0).alias("q9"),
        expr.clip("a", 2.0, 3.0).alias("c"),
        expr.clip("a", upper=0.5).alias("u"),
    ).collect()
    assert [tuple(r) for r in rows] == [(0.5, 0.5, 2.0, 0.5), (None, 9.0, 2.0, 0.5), (None, 9.0, None, None)]


def test_money_text(spark):
    df = spark.createDataFrame([(1.234e9,), (-5.678e6,), (1500.0,), (12.3,), (None,)], "v double")
    assert [r[0] for r in df.select(expr.money_text("v")).collect()] == ["1.23B", "-5.68M", "1.50K", "12.30", "NA"]


def test_pct_change_is_null_for_zero_base(spark):
    row = spark.range(1).select(
        expr.pct_change(F.lit(3.0), F.lit(2.0)).alias("a"),
        expr.pct_change(F.lit(3.0), F.lit(0.0)).alias("b"),
        expr.point_change(F.lit(0.5), F.lit(0.25)).alias("c"),
    ).first()
    assert tuple(row) == (50.0, None, 25.0)


def test_in_years_bounds(spark):
    df = spark.createDataFrame([(date(2012, 12, 31),), (date(2013, 1, 1),), (date(2018, 12, 31),), (date(2019, 1, 1),)], "d date")
    assert [r[0] for r in df.select(expr.in_years("d", 2013, 2018)).collect()] == [False, True, True, False]


def test_calendar_edges(spark):
    days = [date(2021, 1, 1), date(2024, 2, 29), date(2023, 1, 2), date(2023, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "Date date")
    rows = {r["Date"]: r for r in add_calendar_features(df).collect()}
    assert rows[date(2021, 1, 1)]["weekofyear"] == 53
    assert rows[date(2024, 2, 29)]["dayofyear"] == 60
    assert (rows[date(2023, 1, 2)]["dayofweek"], rows[date(2023, 1, 2)]["is_weekend"]) == (0, 0)
    assert (rows[date(2023, 1, 1)]["dayofweek"], rows[date(2023, 1, 1)]["is_weekend"]) == (6, 1)
    assert abs(rows[date(2023, 1, 2)]["dow_cos"] - 1.0) < 1e-12


def test_days_to_holiday_matches_brute_force(spark):
    days = [date(y, m, d) for y in (1999, 2011, 2012, 2016, 2020, 2024, 2025, 2026) for m in range(1, 13) for d in (1, 10, 15, 28)]
    df = spark.createDataFrame([(d,) for d in days], "Date date")
    got = {r["Date"]: r["n"] for r in df.select("Date", days_to_holiday("Date", LUNAR_NEW_YEAR).alias("n")).collect()}
    for d in days:
        near = [(d - h).days for h in LUNAR_NEW_YEAR if abs(h.year - d.year) <= 1]
        assert got[d] == (min(near, key=abs) if near else 0), d


def test_sale_windows(spark):
    days = {
        "black_friday": date(2021, 11, 26), "single": date(2021, 11, 11), "blowout": date(2021, 7, 30),
        "even_year": date(2022, 8, 5), "labor": date(2022, 5, 1), "pre": date(2023, 1, 20), "post": date(2023, 2, 1),
    }
    df = spark.createDataFrame([(d,) for d in days.values()], "Date date")
    rows = {r["Date"]: r for r in add_holiday_features(df).collect()}
    assert rows[days["black_friday"]]["Is_MegaSale"] == 1 and rows[days["single"]]["Is_MegaSale"] == 1
    assert rows[days["black_friday"]]["Is_YearEnd"] == 1
    assert rows[days["blowout"]]["Is_UrbanBlowout"] == 1 and rows[days["even_year"]]["Is_UrbanBlowout"] == 0
    assert rows[days["labor"]]["Is_ReunificationLabor"] == 1
    assert (rows[days["pre"]]["DaysToTet"], rows[days["pre"]]["IsPreTet"], rows[days["pre"]]["IsTetWindow"]) == (-2, 1, 1)
    assert (rows[days["post"]]["DaysToTet"], rows[days["post"]]["IsPostTet"]) == (10, 1)
