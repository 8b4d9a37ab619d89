"""Headline queries on stored inputs made from the test tables: median of three warm runs each, one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all), BENCH_ALL=1 for every query.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import frames  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from ordermill.session import local_session  # noqa: E402

HEADLINE = [
    "orders_unified", "fact_orders", "fact_order_items", "fact_review",
    "daily_sales_summary", "daily_sales_hll", "restaurant_reviews",
    "customer_restaurant_preference", "customer_360", "restaurant_360",
    "daily_item_popularity", "daily_restaurant_performance",
    "forecast_median_fallback", "ljung_box", "forecast_rows",
    "db_live_kpis", "db_top_items", "db_issue_pivot",
]
WARM_RUNS = 3
# Inputs that a deployment has as tables: written out once, outside the timer.
INPUTS = [
    "orders_flat", "order_payloads", "fact_orders", "lines_flat", "fact_order_items", "venues_raw", "customers_raw",
    "whole_menu_raw", "reviews_raw", "fact_review",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = local_session(cores, "bench")
    folder = tempfile.mkdtemp(prefix="bench-")
    frames.store(spark, sf_dir, INPUTS, folder)
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(WARM_RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)
    print(json.dumps({
        "metric": f"sum of median warm seconds over {len(names)} queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
