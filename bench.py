"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR, one JSON line.

``queries`` holds the median of three runs of each query, ``cold`` the first run, which compiles its code.
``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from merclake.plans.catalogue import QUERIES  # noqa: E402
from merclake.session import forget_shared, local_session  # noqa: E402

HEADLINE = [
    "sales_by_category", "sales_overview", "sales_trend_daily", "top_selling_products", "order_metrics",
    "daily_sales_full", "product_performance", "customer_lifetime_value", "rfm_scores", "enrich_customers",
    "customer_features", "churn_features", "product_features", "customer_behaviour", "demand_features", "interactions",
    "order_time_features", "latest_orders_per_customer", "clean_orders", "outliers_iqr", "validate_orders",
    "profile_orders", "anomaly_detect", "order_anomalies", "session_windows", "sessionize", "funnel", "last_touch",
    "parse_events", "insert_ignore", "upsert",
    "run_full_etl", "at_risk_customers", "churn_dataset", "daily_batch_etl", "load_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(
        cpus, shuffle_partitions=cpus,
        **{"spark.driver.memory": "8g", "spark.python.sql.dataFrameDebugging.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs: list[dict[str, float]] = []
    for _ in range(3):
        runs.append({})
        for name in names:
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[-1][name] = round(time.perf_counter() - started, 3)
    usual = {name: statistics.median(r[name] for r in runs) for name in names}
    forget_shared(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(usual.values()), 3), "unit": "sec",
        "queries": usual, "cold": runs[0], "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
