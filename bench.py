"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from meterlens.plans.catalog import QUERIES
from meterlens.session import session_builder

HEADLINE = [
    "ingest_readings", "overall_stats", "building_summary", "building_statistics",
    "weather_correlation", "temperature_ranges", "type_performance", "hourly_patterns",
    "insights", "feature_thresholds", "numeric_describe", "three_sigma", "iqr",
    "moving_average", "moving_average_asof", "ensemble", "detect_batch",
    "anomalous_parameters", "recent_24", "explore_page", "sample_readings",
    "stratified_split", "bloom_dedup", "alert_dedup", "exact_window_count", "dgim_count",
    "sliding_counts", "session_counts", "gbt_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        session_builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["building_detail"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": seconds, "sf": scale.removeprefix("sf")}))


if __name__ == "__main__":
    main()
