"""Seconds per headline query; prints one JSON line.

Every query is written whole to Spark's ``noop`` sink, so that no column or row is
optimized away. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma-separated
names) choose data, cores and queries.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from archive_spark.bindings import QUERIES
from archive_spark.session import get_session

HEADLINE = [
    "count_by_year",
    "row_counts",
    "parse_flexible_date",
    "date_from_url",
    "py_strip",
    "reporters",
    "parse_pages",
    "concat_text",
    "distinct_requests",
    "hop",
    "segments_with_pages",
    "carry_program",
    "records_with_file",
    "file_match_counts",
    "reconcile",
    "latest_page",
    "upsert_segments",
    "malformed_meta",
    "duplicate_segments",
    "id_gap_ranges",
    "special_segments",
    "programs",
    "evening_segments",
    "stream_segments",
    "year_subset_report",
    "build_segments",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": memory,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "spark": pyspark.__version__,
        "cpus": int(cpus),
        "memory": memory,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
