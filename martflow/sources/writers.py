"""Sinks: CSV and Parquet layers, metric JSON, and the submission file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_many(tables: dict[str, DataFrame], out_dir: str) -> list[str]:
    return [save_csv(df, f"{out_dir}/{name.removesuffix('.csv')}.csv") for name, df in tables.items()]


def save_layer(df: DataFrame, layer_dir: str, name: str, month_of: str | None = None) -> DataFrame:
    """Write a mart or interim table as Parquet and return it read back.

    ``month_of`` names a date column: the table is then partitioned by its month, so that later
    date filters prune whole folders. Rows are first clustered by that month, which keeps the
    number of files per folder in step with its size (adaptive execution splits the big ones).
    """
    path = f"{layer_dir}/{name}"
    writer = df
    if month_of:
        writer = df.withColumn("month_part", F.date_format(F.col(month_of), "yyyy-MM")).hint(
            "rebalance", "month_part"
        )
    out = writer.write.mode("overwrite")
    (out.partitionBy("month_part") if month_of else out).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.drop("month_part")


def save_months(df: DataFrame, layer_dir: str, name: str, month_of: str, months: list[str]) -> DataFrame:
    """Replace the given months (``yyyy-MM``) of a table that ``save_layer`` wrote by month; returns the whole table.

    ``df`` holds the new rows of these months and no others. Each month is a folder and is written by a job of its
    own, so a month that has no rows any more ends up empty, and months that are not named are never touched.
    """
    path = f"{layer_dir}/{name}"
    for month in months:
        own = df.where(F.date_format(F.col(month_of), "yyyy-MM") == month)
        own.write.mode("overwrite").parquet(f"{path}/month_part={month}")
    return df.sparkSession.read.parquet(path).drop("month_part")


def save_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write the table in buckets of its key and return it read back: joins of tables with equal buckets on that
    key, and aggregations by it, need no shuffle. Rows are dealt to their bucket before they are written, so there is
    one file a bucket."""
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def save_metrics(metrics: DataFrame, path: str) -> str:
    """One-row KPI frame as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def submission_rows(forecast: DataFrame) -> DataFrame:
    """Date as text and money rounded to cents (half to even)."""
    return forecast.select(
        F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        F.bround("Revenue", 2).alias("Revenue"),
        F.bround("COGS", 2).alias("COGS"),
    )


def save_submission(forecast: DataFrame, path: str) -> str:
    """One ordered CSV file; a forecast has one row per day of the horizon, so one task suffices."""
    submission_rows(forecast).orderBy("Date").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
