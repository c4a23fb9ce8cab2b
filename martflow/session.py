"""Session defaults for interactive use, tests and the benchmark.

Only settings that matter for these jobs are set; a cluster's own configuration wins
because ``getOrCreate`` never overrides what the submitter has already fixed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Rows of the largest input for each shuffle partition of a sized session.
ROWS_A_PARTITION = 250_000

# Spark sizes tasks by compressed bytes, and rows of keys and dates take 5 to 20 bytes: its 128 MB a read task and
# 64 MB a merged shuffle partition are over ten million rows for one task to sort or aggregate.
DENSE_ROWS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    # A hot key is split even if that costs an extra shuffle; and a side that lies by order need not be
    # shuffled again to be joined by order and product.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def sized_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session of the same application whose tasks hold a bounded number of dense rows, for inputs of ``rows`` rows.

    Settings of the given session are taken over and stay untouched there; smaller sizes and more partitions of its
    own are kept.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in DENSE_ROWS.items():
        if not value[0].isdigit() or in_bytes(spark.conf.get(key)) > in_bytes(value):
            own.conf.set(key, value)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_PARTITION))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


def in_bytes(size: str) -> int:
    """Bytes of a size as Spark writes it, such as 64MB, 8m or 1024."""
    number = size.lower().rstrip("bkmgtp")
    unit = size.lower()[len(number) :].rstrip("b")
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def build_session(app_name: str = "martflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A straggler from a hot key costs more than one extra shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites are not recorded for every column expression; plans build about twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
