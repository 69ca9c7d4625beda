"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local threads; names given as arguments
replace the headline list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks import catalog

HEADLINE = [
    "calendar_features",
    "duration_in_minutes",
    "dedup_by_key",
    "median_impute",
    "missing_report",
    "hourly_counts",
    "hotspot_summary",
    "top_values",
    "top_weather",
    "map_sample_all",
    "stratified_split",
    "column_modes",
    "one_hot",
    "standardise",
    "assign_centroid",
    "silhouette",
    "best_k",
    "classification_report",
    "kmeans_sweep",
    "hotspots_of_incidents",
    "risk_predictions",
    "engineered_incidents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session pays for class loading.
    catalog.QUERIES["hourly_counts"](spark, sf_dir).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
