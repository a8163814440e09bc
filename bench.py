"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the data, ``BENCH_CPUS`` the cores,
``BENCH_RUNS`` the timed repetitions after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tributary.plans import REGISTRY

HEADLINE = [
    "tumbling_daily_totals", "sliding_daily_totals", "three_granularities", "value_percentiles_per_day", "purchase_sessions",
    "session_actions", "rolling_average", "fraud_alerts", "adaptive_threshold_alerts", "session_quality_reports",
    "clicks_after_views", "orders_with_customers", "sales_with_part_origin", "best_seller_of_each_day", "cheapest_tenth_per_bracket",
    "top_hashtags_by_window", "sensor_outliers", "unusual_key_counts", "stock_lines_valid", "normalized_texts",
    "document_sentiment", "similar_text_pairs", "stream_daily_totals", "stream_rolling_average",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in wanted:
        taken = []
        repeat = 1 if name.startswith("stream_") else runs
        for _ in range(repeat + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 4)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 4)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
