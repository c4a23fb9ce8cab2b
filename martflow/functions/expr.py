"""Scalar column expressions: ratios, bounds, flags, labels, text."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Order statuses that count as a completed sale and need a shipment.
SOLD_STATUSES = ("delivered", "returned", "shipped")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """Quotient that is NULL, or ``default`` when given, wherever the denominator is 0 or NULL."""
    ratio = F.try_divide(col(num), col(den))
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def divide_if_positive(num: Column | str, den: Column | str) -> Column:
    return F.when(col(den) > 0, F.try_divide(col(num), col(den)))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def clip(c: Column | str, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value on either side; NULL stays NULL (greatest/least alone would drop it)."""
    value = col(c)
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)


def is_true(condition: Column) -> Column:
    """Three-valued logic folded to two: an unknown comparison counts as false."""
    return F.coalesce(condition, F.lit(False))


def pct_change(after: Column | str, before: Column | str) -> Column:
    return (F.try_divide(col(after), col(before)) - 1) * 100


def point_change(after: Column | str, before: Column | str) -> Column:
    return (col(after) - col(before)) * 100


def period_label(year: Column | str, split_year: int, before: str = "pre", after: str = "post") -> Column:
    return F.when(col(year) <= split_year, F.lit(before)).otherwise(F.lit(after))


def in_years(day: Column | str, first: int, last: int) -> Column:
    """Year range written as a half-open date range, so it can be pushed into a Parquet scan."""
    return (col(day) >= F.lit(date(first, 1, 1))) & (col(day) < F.lit(date(last + 1, 1, 1)))


def any_present(columns: Iterable[str]) -> Column:
    present = F.lit(False)
    for name in columns:
        present = present | F.col(name).isNotNull()
    return present


def all_present(columns: Iterable[str]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def flag(condition: Column) -> Column:
    return is_true(condition).cast("int")


def count_true(condition: Column) -> Column:
    """Number of rows for which the condition holds (0, not NULL, for an empty group)."""
    return F.count_if(condition)


def sum_or_zero(c: Column | str) -> Column:
    """Sum in which a group without values gives 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def money_text(c: Column | str) -> Column:
    """Short text of an amount: 1.23B, 4.56M, 7.89K, 12.34, or NA for a missing one."""
    value = col(c)
    size = F.abs(value)
    return (
        F.when(value.isNull(), "NA")
        .when(size >= 1e9, F.format_string("%.2fB", value / 1e9))
        .when(size >= 1e6, F.format_string("%.2fM", value / 1e6))
        .when(size >= 1e3, F.format_string("%.2fK", value / 1e3))
        .otherwise(F.format_string("%.2f", value))
    )


def keep_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Project the wanted columns that exist; decided while the plan is built."""
    return df.select(*[c for c in wanted if c in df.columns])


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present: a missing key forms no group."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def with_line_money(items: DataFrame, profit: str = "gross_profit", margin: str = "gross_margin") -> DataFrame:
    """Revenue, cost, profit and margin of an order line from quantity, unit price and unit cost."""
    revenue = F.col("quantity") * F.col("unit_price")
    cost = F.col("quantity") * F.col("cogs")
    return items.withColumns(
        {
            "line_revenue": revenue,
            "line_cogs": cost,
            profit: revenue - cost,
            margin: divide_if_positive(revenue - cost, revenue),
        }
    )
