"""Time the headline queries on local Spark and print one JSON line.

BENCH_SF_DIR   folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import sys
import time

from martflow.plans.queries import QUERIES
from martflow.session import build_session

HEADLINE = [
    # loaders, quality
    "order_level", "item_level", "null_report", "null_profile", "key_profile", "fk_coverage", "audit_overview", "join_log",
    # joins, facts, marts
    "items_orders", "orders_shipments", "returns_agg", "item_fact", "order_line_fact", "order_fact", "customer_360",
    "product_360", "product_mart", "daily_panel", "product_month_panel",
    # answers
    "monthly_revenue", "monthly_resample", "regime_shift", "revenue_anomalies", "customer_health", "order_gap_stats",
    "repurchase_90d", "lead_time_stats", "promo_diag", "category_regime", "category_summary", "rating_return",
    "sku_pareto", "sku_action_2x2", "sku_action_q70", "sku_buckets", "conversion_funnel", "region_revenue",
    # features and forecast
    "rolling_features", "seasonal_profiles", "forecast_features", "rolling_origin", "metrics", "cogs_corrections",
    # wide audits and panels
    "audit_conclusion", "null_classes", "mart_checks", "promo_effect", "promo_gaps", "daily_order_facts", "holiday_forecast_features",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "martflow-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's code generation and the file system once, outside the timings.
    run(spark, "monthly_revenue", sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name:24s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
