"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed, from building its plan to
the last row written to a sink that keeps nothing. Making the incident table
and the raw file from ``orders`` is timed apart, as ``load``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadlens.session import DEFAULTS  # noqa: E402
from workload.incidents import incidents, raw_file  # noqa: E402
from workload.registry import all_queries  # noqa: E402

HEADLINES = (
    "scan_count", "severity_share", "state_share_rank", "top15_category", "bucket_stats", "monthly_change",
    "yearly_change", "running_total", "hour_ranks", "flag_split", "top20_city", "top5_per_state",
    "state_dense_rank", "rank_divergence", "flag_compare", "category_pivot", "funnel_overall",
    "funnel_by_context", "monthly_cohort", "state_funnel", "mart_temporal", "mart_geo", "mart_weather_poi",
    "mart_funnel", "highlights", "dim_location", "dim_time", "fact", "star_join", "clean_pipeline",
    "drop_null_rows", "load_and_stage", "keyword_context", "filter_stats", "point_sample", "hex_bin", "heat_grid",
    "null_audit", "value_frequencies", "column_profile", "dq_unique", "dq_relationships", "serial_id",
    "raw_split_read", "versioned_refresh", "mart_funnel_arrivals", "layout_clustered", "point_lookup", "star_by_location",
    "dq_relationships_dense", "heat_pyramid", "stats_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        **DEFAULTS, "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    start = time.perf_counter()
    incidents(spark, sf_dir)
    raw_file(spark, sf_dir)
    load = round(time.perf_counter() - start, 3)
    for name in HEADLINES:
        for run in ("warm", "timed"):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run == "timed":
                seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "load": load, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
