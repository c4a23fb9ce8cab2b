"""Calendar, cyclic and holiday columns derived from a date column."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.expr import col, flag

# First day of the lunar new year, 2012 to 2024.
LUNAR_NEW_YEAR = [
    date(2012, 1, 23), date(2013, 2, 10), date(2014, 1, 31), date(2015, 2, 19), date(2016, 2, 8),
    date(2017, 1, 28), date(2018, 2, 16), date(2019, 2, 5), date(2020, 1, 25), date(2021, 2, 12),
    date(2022, 2, 1), date(2023, 1, 22), date(2024, 2, 10),
]

# One-day sales as (month, day).
MEGA_SALE_DAYS = [(11, 11), (12, 12), (2, 14), (3, 8)]

# Column lists of the two forecast feature sets.
CALENDAR_COLUMNS = ["Month", "Day", "DayOfWeek", "DayOfYear", "Quarter", "WeekOfYear", "IsWeekend", "IsOddYear"]
CYCLIC_COLUMNS = ["doy_sin", "doy_cos", "dom_sin", "dom_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
SALE_WINDOW_COLUMNS = [
    "Is_MegaSale", "Is_UrbanBlowout", "Is_RuralSpecial", "Is_SpringSale", "Is_MidYearSale",
    "Is_FallLaunch", "Is_YearEnd", "Is_ReunificationLabor",
]
LUNAR_COLUMNS = ["DaysToTet", "IsTetWindow", "IsPreTet", "IsPostTet"]


def month_key(day: Column | str) -> Column:
    return F.date_format(col(day), "yyyy-MM")


def month_start(day: Column | str) -> Column:
    return F.trunc(col(day), "MM")


def slot(day: Column | str) -> dict[str, Column]:
    """The (month, day of month) calendar slot of a date."""
    return {"Month": F.month(col(day)), "Day": F.dayofmonth(col(day))}


def cycle(name: str, value: Column, length: float) -> dict[str, Column]:
    angle = value * F.lit(2.0) * F.pi() / F.lit(float(length))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def add_year_month(df: DataFrame, date_col: str) -> DataFrame:
    d = F.col(date_col)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "year_month": month_key(d)})


def add_calendar_features(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Date parts (Monday is 0, ISO week), weekend flag and month/weekday cycles."""
    d = F.col(date_col)
    weekday, month = F.weekday(d), F.month(d)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": month,
            "day": F.dayofmonth(d),
            "dayofweek": weekday,
            "dayofyear": F.dayofyear(d),
            "weekofyear": F.weekofyear(d),
            "is_weekend": flag(weekday >= 5),
            "quarter": F.quarter(d),
            **cycle("month", month, 12),
            **cycle("dow", weekday, 7),
        }
    )


def add_forecast_calendar(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Eight calendar and eight cyclic columns of the forecast feature frame, plus Year."""
    d = F.col(date_col)
    weekday, month, day, doy = F.weekday(d), F.month(d), F.dayofmonth(d), F.dayofyear(d)
    return df.withColumns(
        {
            "Year": F.year(d),
            "Month": month,
            "Day": day,
            "DayOfWeek": weekday,
            "DayOfYear": doy,
            "Quarter": F.quarter(d),
            "WeekOfYear": F.weekofyear(d),
            "IsWeekend": flag(weekday >= 5),
            "IsOddYear": F.year(d) % 2,
            **cycle("doy", doy, 365.25),
            **cycle("dom", day, 31),
            **cycle("dow", weekday, 7),
            **cycle("month", month, 12),
        }
    )


def days_to_holiday(day: Column | str, holidays: list[date]) -> Column:
    """Signed days to the nearest holiday of the previous, same or next year; 0 when none is known.

    The holiday list is a short literal array, so this stays a row expression without a join. On a
    tie the earlier holiday wins because the struct compares distance first, then date.
    """
    d = col(day)
    known = F.array(*[F.lit(h) for h in holidays])
    near = F.filter(known, lambda h: F.abs(F.year(h) - F.year(d)) <= 1)
    ranked = F.transform(
        near,
        lambda h: F.struct(F.abs(F.datediff(d, h)).alias("gap"), h.alias("h"), F.datediff(d, h).alias("days")),
    )
    return F.coalesce(F.array_min(ranked)["days"], F.lit(0))


def add_holiday_features(
    df: DataFrame, date_col: str = "Date", lunar_new_year: list[date] = LUNAR_NEW_YEAR
) -> DataFrame:
    """Sale-window and lunar-new-year flags on top of :func:`add_forecast_calendar`."""
    month, day, odd = F.col("Month"), F.col("Day"), F.col("IsOddYear") == 1
    black_friday = (month == 11) & (F.col("DayOfWeek") == 4) & day.between(22, 28)
    mega = black_friday
    for m, d in MEGA_SALE_DAYS:
        mega = mega | ((month == m) & (day == d))
    to_tet = F.col("DaysToTet")
    return (
        add_forecast_calendar(df, date_col)
        .withColumns(
            {
                "Is_MegaSale": flag(mega),
                "Is_UrbanBlowout": flag(odd & in_summer_blowout(month, day)),
                "Is_RuralSpecial": flag(odd & (month == 1)),
                "Is_SpringSale": flag(month == 3),
                "Is_MidYearSale": flag(month == 6),
                "Is_FallLaunch": flag(
                    ((month == 8) & (day >= 30)) | (month == 9) | ((month == 10) & (day <= 2))
                ),
                "Is_YearEnd": flag(in_year_end(month, day)),
                "Is_ReunificationLabor": flag(
                    ((month == 4) & (day == 30)) | ((month == 5) & (day == 1))
                ),
                "DaysToTet": days_to_holiday(date_col, lunar_new_year),
            }
        )
        .withColumns(
            {
                "IsTetWindow": flag(F.abs(to_tet) <= 7),
                "IsPreTet": flag((to_tet >= -14) & (to_tet < 0)),
                "IsPostTet": flag((to_tet > 0) & (to_tet <= 14)),
            }
        )
    )


def in_summer_blowout(month: Column, day: Column) -> Column:
    """30 July to 2 September."""
    return ((month == 7) & (day >= 30)) | (month == 8) | ((month == 9) & (day <= 2))


def in_year_end(month: Column, day: Column) -> Column:
    """18 November to 31 December."""
    return ((month == 11) & (day >= 18)) | (month == 12)
