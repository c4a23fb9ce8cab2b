"""Exact global order, running totals and quantiles without putting all rows in one task.

A window without PARTITION BY, and an exact percentile, both end in a single task. For frames
whose row count grows with the data (products, for instance) the order is instead cut into range
partitions; each partition is ranked on its own and then shifted by the totals of the partitions
before it. The cut is fixed by a reliable checkpoint, so a lost executor cannot move a boundary.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach, as the session names it; a temporary one only for a local run without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = tempfile.mkdtemp(prefix="martflow-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; make one only for a local run that has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Write the frame once to the reliable checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def running_totals(
    df: DataFrame, order_by: list[Column], sums: dict[str, Column], rank: str | None = None
) -> DataFrame:
    """Add a global 1-based rank and, per entry of ``sums``, the running and the grand total.

    For an entry ``name`` the new columns are ``name`` (running, inclusive) and ``name_total``.
    ``order_by`` must end in a unique column: the range cut then also splits runs of equal values.
    """
    rank_col = rank or "_rank"
    chunk = Window.partitionBy("_chunk").orderBy(*order_by)
    so_far = chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = {f"_value_{name}": F.coalesce(value, F.lit(0)) for name, value in sums.items()}

    ranked = materialize(
        df.withColumns(values)
        .repartitionByRange(*order_by)
        .withColumn("_chunk", F.spark_partition_id())
        .withColumn(rank_col, F.row_number().over(chunk).cast("bigint"))
        .withColumns({name: F.sum(f"_value_{name}").over(so_far) for name in sums})
    )

    # One row per range partition, so at most spark.sql.shuffle.partitions rows.
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    chunk_totals = ranked.groupBy("_chunk").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_value_{name}").alias(f"_sum_{name}") for name in sums]
    )
    shifts = chunk_totals.select(
        "_chunk",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(everything).alias(f"{n}_total") for n in sums],
    )
    shifted = ranked.join(F.broadcast(shifts), "_chunk").withColumns(
        {
            rank_col: F.col(rank_col) + F.col("_rows_before"),
            **{name: F.col(name) + F.col(f"_before_{name}") for name in sums},
        }
    )
    helper = ["_chunk", "_rows_before", *[f"_value_{n}" for n in sums], *[f"_before_{n}" for n in sums]]
    return shifted.drop(*helper, *([] if rank else [rank_col]))


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, Column]:
    """Linearly interpolated quantiles, each returned as a scalar subquery column.

    ``wanted`` maps a name to (column, probability). Distinct values are counted and ranked over range
    partitions, whatever the size of the frame; the positions of a quantile are then one or two rows.
    """
    ranked: dict[str, DataFrame] = {}
    result: dict[str, Column] = {}
    for name, (c, p) in wanted.items():
        if c not in ranked:
            ranked[c] = _ranked_values(df, c)
        result[name] = _value_at(ranked[c], p)
    return result


def _ranked_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their count and the number of rows up to and including them.

    Counting first keeps a value that a third of the rows share from filling one partition.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return running_totals(counted, [F.col("value").asc()], {"upto": F.col("n")})


def _value_at(ranked: DataFrame, p: float) -> Column:
    position = F.lit(p) * (F.col("upto_total") - 1)
    low, high = F.floor(position), F.ceil(position)

    def covers(k: Column) -> Column:
        return (F.col("upto") - F.col("n") <= k) & (k < F.col("upto"))

    lower = F.max(F.when(covers(low), F.col("value")))
    upper = F.max(F.when(covers(high), F.col("value")))
    share = F.max(position - low)
    return (
        ranked.where(covers(low) | covers(high))
        .agg((lower + (upper - lower) * share).alias("quantile"))
        .scalar()
    )
