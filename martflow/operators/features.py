"""Forecast features: lags, rolling statistics, calendar-slot profiles and the full feature frames.

Series frames have one row per calendar day (and per series when ``series`` is given), slot tables
one row per month, (month, day) or (month, weekday).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.calendar import (
    CALENDAR_COLUMNS,
    CYCLIC_COLUMNS,
    LUNAR_COLUMNS,
    SALE_WINDOW_COLUMNS,
    add_forecast_calendar,
    add_holiday_features,
    slot,
)
from martflow.functions.expr import flag, known, safe_divide
from martflow.operators.joins import slot_lookup

# Feature lists of the two forecast variants (33 and 39 columns) and their groups.
SEASONAL_COLUMNS = ["rev_doy_median", "rev_month_dow_mean", "rev_month_day_median"]
AUX_COLUMNS = [
    "inv_stockout", "inv_fillrate", "inv_sellthru", "returns_md", "sessions_md", "visitors_md",
    "avg_ship_fee", "avg_delivery_days",
]
SLOT_FLAG_COLUMNS = [
    "md_rev_ratio", "is_hi_rev_md", "is_lo_rev_md", "md_ratio_odd", "md_ratio_even", "md_ratio_post",
]
FORECAST_FEATURES = CALENDAR_COLUMNS + CYCLIC_COLUMNS + SEASONAL_COLUMNS + AUX_COLUMNS + SLOT_FLAG_COLUMNS
HOLIDAY_FEATURES = (
    CALENDAR_COLUMNS + SALE_WINDOW_COLUMNS + LUNAR_COLUMNS + CYCLIC_COLUMNS + SEASONAL_COLUMNS + AUX_COLUMNS
)
FEATURE_GROUPS = {
    "Seasonal medians": SEASONAL_COLUMNS,
    "Data-derived flags": SLOT_FLAG_COLUMNS + SALE_WINDOW_COLUMNS + LUNAR_COLUMNS,
    "Calendar basics": CALENDAR_COLUMNS,
    "Fourier": CYCLIC_COLUMNS,
    "AUX aggregates": AUX_COLUMNS,
}

MONTH_DAY = ["Month", "Day"]


def feature_columns(df: DataFrame, target_col: str = "Revenue", date_col: str = "Date") -> list[str]:
    return [c for c in df.columns if c not in {target_col, "COGS", date_col}]


# ---------------------------------------------------------------- lags and rolling windows


def add_lag_features(
    df: DataFrame,
    target_col: str = "Revenue",
    lags: tuple[int, ...] = (1, 7, 14, 28),
    date_col: str = "Date",
    series: tuple[str, ...] = (),
) -> DataFrame:
    """Values of earlier rows. With many series, name their key so that each is its own partition."""
    ordered = Window.partitionBy(*series).orderBy(date_col)
    return df.withColumns({f"{target_col}_lag_{k}": F.lag(target_col, k).over(ordered) for k in lags})


def add_rolling_features(
    df: DataFrame,
    target_col: str = "Revenue",
    windows: tuple[int, ...] = (7, 14, 28),
    date_col: str = "Date",
    series: tuple[str, ...] = (),
) -> DataFrame:
    """Mean, deviation, minimum and maximum of the previous rows, once all of them are there."""
    ordered = Window.partitionBy(*series).orderBy(date_col)
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    columns = {}
    for size in windows:
        before = ordered.rowsBetween(-size, -1)
        full = F.count(target_col).over(before) == size
        for name, aggregate in stats.items():
            columns[f"{target_col}_roll_{name}_{size}"] = F.when(full, aggregate(target_col).over(before))
    return df.withColumns(columns)


# ---------------------------------------------------------------- calendar-slot tables


def slot_revenue_flags(sales: DataFrame, high: float = 0.90, low: float = 0.10) -> DataFrame:
    """Mean revenue per (month, day), its ratio to the overall mean, and high/low slot flags."""
    slots = known(sales, "Date").groupBy(*[c.alias(n) for n, c in slot("Date").items()]).agg(
        F.avg("Revenue").alias("md_avg_rev")
    )
    overall = sales.agg(F.avg("Revenue")).scalar()
    cuts = slots.agg(
        F.struct(
            F.percentile("md_avg_rev", F.lit(high)).alias("high"),
            F.percentile("md_avg_rev", F.lit(low)).alias("low"),
        )
    ).scalar()
    return slots.withColumns(
        {
            "md_rev_ratio": safe_divide(F.col("md_avg_rev"), overall),
            "is_hi_rev_md": flag(F.col("md_avg_rev") > cuts["high"]),
            "is_lo_rev_md": flag(F.col("md_avg_rev") < cuts["low"]),
        }
    )


def slot_cost_ratios(sales: DataFrame, post_from: int = 2019) -> DataFrame:
    """Mean daily cost ratio per (month, day) over odd, even and recent years, in one pass."""
    year, ratio = F.year("Date"), safe_divide("COGS", "Revenue")
    return known(sales, "Date").groupBy(*[c.alias(n) for n, c in slot("Date").items()]).agg(
        F.avg(F.when(year % 2 == 1, ratio)).alias("md_ratio_odd"),
        F.avg(F.when(year % 2 == 0, ratio)).alias("md_ratio_even"),
        F.avg(F.when(year >= post_from, ratio)).alias("md_ratio_post"),
    )


def top_blowout_slots(sales: DataFrame, top: int = 10) -> DataFrame:
    """Slots with the highest cost ratio in odd years."""
    return (
        slot_cost_ratios(sales)
        .select("Month", "Day", "md_ratio_odd")
        .where(F.col("md_ratio_odd").isNotNull())
        .orderBy(F.desc("md_ratio_odd"), "Month", "Day")
        .limit(top)
    )


@dataclass(frozen=True)
class AuxSlots:
    """Slot means of the tables around sales: stock per month, the others per (month, day)."""

    inventory: DataFrame
    returns: DataFrame
    traffic: DataFrame
    shipments: DataFrame

    def long(self) -> DataFrame:
        """All slot values as (slot_table, Month, Day, measure, value)."""
        parts = []
        for name in ("inventory", "returns", "traffic", "shipments"):
            table: DataFrame = getattr(self, name)
            day = F.col("Day") if "Day" in table.columns else F.lit(None).cast("int")
            measures = [c for c in table.columns if c not in MONTH_DAY]
            entries = F.array(
                *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
            )
            parts.append(
                table.select(F.lit(name).alias("slot_table"), "Month", day.alias("Day"), F.explode(entries).alias("e"))
                .select("slot_table", "Month", "Day", "e.*")
            )
        first, *rest = parts
        for part in rest:
            first = first.unionByName(part)
        return first


def aux_slots(
    inventory: DataFrame, web_traffic: DataFrame, returns: DataFrame, shipments: DataFrame
) -> AuxSlots:
    def by_slot(df: DataFrame, day: str) -> tuple[DataFrame, list[Column]]:
        return known(df, day), [c.alias(n) for n, c in slot(day).items()]

    stock = known(inventory, "snapshot_date").groupBy(F.month("snapshot_date").alias("Month")).agg(
        F.avg("stockout_days").alias("inv_stockout"),
        F.avg("fill_rate").alias("inv_fillrate"),
        F.avg("sell_through_rate").alias("inv_sellthru"),
    )
    visits, keys = by_slot(web_traffic, "date")
    traffic = visits.groupBy(*keys).agg(
        F.avg("sessions").alias("sessions_md"), F.avg("unique_visitors").alias("visitors_md")
    )
    returned, keys = by_slot(returns, "return_date")
    back = returned.groupBy(*keys).agg(F.count(F.lit(1)).alias("returns_md"))
    shipped, keys = by_slot(shipments, "ship_date")
    sent = shipped.groupBy(*keys).agg(
        F.avg("shipping_fee").alias("avg_ship_fee"),
        F.avg(F.datediff("delivery_date", "ship_date")).alias("avg_delivery_days"),
    )
    return AuxSlots(stock, back, traffic, sent)


@dataclass(frozen=True)
class SeasonalProfiles:
    day_of_year: DataFrame
    month_weekday: DataFrame
    month_day: DataFrame
    overall: Column

    def long(self) -> DataFrame:
        """All profile values as (profile, slot_a, slot_b, value)."""
        kinds = [
            ("doy_median", self.day_of_year, ["DayOfYear"], "rev_doy_median"),
            ("month_dow_mean", self.month_weekday, ["Month", "DayOfWeek"], "rev_month_dow_mean"),
            ("month_day_median", self.month_day, MONTH_DAY, "rev_month_day_median"),
        ]
        parts = [
            table.select(
                F.lit(name).alias("profile"),
                F.col(keys[0]).alias("slot_a"),
                (F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("int")).alias("slot_b"),
                F.col(value).alias("value"),
            )
            for name, table, keys, value in kinds
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def seasonal_profiles(train: DataFrame, target_col: str = "Revenue", date_col: str = "Date") -> SeasonalProfiles:
    """Median by day of year and by (month, day), mean by (month, weekday), overall median.

    A slot holds one row per year (a weekday slot a few per year), so exact medians stay small.
    """
    d = F.col(date_col)
    train = known(train, date_col)
    month, day, weekday, doy = F.month(d), F.dayofmonth(d), F.weekday(d), F.dayofyear(d)
    return SeasonalProfiles(
        train.groupBy(doy.alias("DayOfYear")).agg(F.median(target_col).alias("rev_doy_median")),
        train.groupBy(month.alias("Month"), weekday.alias("DayOfWeek")).agg(
            F.avg(target_col).alias("rev_month_dow_mean")
        ),
        train.groupBy(month.alias("Month"), day.alias("Day")).agg(
            F.median(target_col).alias("rev_month_day_median")
        ),
        train.agg(F.median(target_col)).scalar(),
    )


def apply_profiles(days: DataFrame, profiles: SeasonalProfiles) -> DataFrame:
    """Attach the three profiles; a slot without history takes the overall median."""
    for table, keys, value in (
        (profiles.day_of_year, ["DayOfYear"], "rev_doy_median"),
        (profiles.month_weekday, ["Month", "DayOfWeek"], "rev_month_dow_mean"),
        (profiles.month_day, MONTH_DAY, "rev_month_day_median"),
    ):
        days = slot_lookup(days, table, keys, {value: profiles.overall})
    return days


# ---------------------------------------------------------------- feature frames


def fill_with_mean(df: DataFrame, columns: list[str], role: str = "role") -> DataFrame:
    """Fill gaps of each column with that column's mean among the rows of the same role.

    Train and horizon days are the two roles, so this is a frame of calendar days.
    """
    same_role = Window.partitionBy(role)
    return df.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(same_role)) for c in columns})


def add_aux_aggregates(days: DataFrame, aux: AuxSlots, role: str = "role") -> DataFrame:
    days = slot_lookup(days, aux.inventory, ["Month"])
    for table in (aux.returns, aux.traffic, aux.shipments):
        days = slot_lookup(days, table, MONTH_DAY)
    return fill_with_mean(days, AUX_COLUMNS, role)


def add_slot_flags(days: DataFrame, sales: DataFrame, post_from: int, role: str = "role") -> DataFrame:
    flags = slot_revenue_flags(sales).drop("md_avg_rev")
    days = slot_lookup(days, flags, MONTH_DAY, {"is_hi_rev_md": F.lit(0), "is_lo_rev_md": F.lit(0)})
    days = slot_lookup(days, slot_cost_ratios(sales, post_from), MONTH_DAY)
    return fill_with_mean(days, ["md_rev_ratio", "md_ratio_odd", "md_ratio_even", "md_ratio_post"], role)


def train_and_horizon(train: DataFrame, horizon: DataFrame) -> DataFrame:
    """Both frames in one, told apart by ``role``; the horizon keeps only its dates."""
    future = horizon.select(
        "Date", F.lit(None).cast("double").alias("Revenue"), F.lit(None).cast("double").alias("COGS")
    )
    past = train.select("Date", "Revenue", "COGS")
    return past.withColumn("role", F.lit("train")).unionByName(future.withColumn("role", F.lit("test")))


def forecast_features(train: DataFrame, horizon: DataFrame, aux: AuxSlots, post_from: int = 2019) -> DataFrame:
    """The 33 features of every training and horizon day, derived from training data only."""
    days = add_forecast_calendar(train_and_horizon(train, horizon))
    days = add_slot_flags(add_aux_aggregates(days, aux), train, post_from)
    days = apply_profiles(days, seasonal_profiles(train))
    return days.select("Date", "role", "Year", "Revenue", "COGS", *FORECAST_FEATURES)


def holiday_forecast_features(train: DataFrame, horizon: DataFrame, aux: AuxSlots) -> DataFrame:
    """The 39 features with sale windows and lunar new year instead of slot flags."""
    days = add_holiday_features(train_and_horizon(train, horizon))
    days = apply_profiles(add_aux_aggregates(days, aux), seasonal_profiles(train))
    return days.select("Date", "role", "Year", "Revenue", "COGS", *HOLIDAY_FEATURES)
