"""Time the headline queries: ``BENCH_SF_DIR=... BENCH_CPUS=... python bench.py``.

Prints one JSON line. Each query runs once to warm up and is then timed in full: planning, all
tables it writes (each run writes its own anew), and every row of its result into a sink that
discards it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry import QUERIES  # noqa: E402
from registry.base import forget_written  # noqa: E402

HEADLINE = (
    "window_counts_of_points", "to_points", "to_docs", "apply_mapping", "metric_query", "tag_values",
    "upsert_points", "upsert_docs", "parse_raw_logs", "raw_to_points", "read_ops_csv", "files_to_load",
    "match_text", "search_topk", "points_payload", "load_period", "load_both", "load_present",
    "read_points", "compact_points", "compact_docs", "delete_stored_points", "load_backwards", "load_csv_both",
)


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    forget_written()
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loglake-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(seconds(spark, name, sf_dir), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
