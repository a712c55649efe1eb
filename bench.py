"""Times the headline queries and prints one JSON line.

$BENCH_SF_DIR (default /root/testdata/sf0.1) and $BENCH_CPUS (default 8) choose data
and cores. Each query is run once to warm up, then BENCH_RUNS times (default 3), its
whole result forced by a noop write; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from shelftrail import session
from workload.queries import QUERIES

HEADLINE = [
    "discounted_items", "units_sold_all", "units_sold_by_date", "daily_stock_summary",
    "daily_stock_summary_approx", "price_changes", "code_series_all", "price_search", "new_low_today",
    "duplicate_repair", "duplicate_titles", "title_features", "ingest_positional", "ingest_by_name",
    "page_metadata",
    "line_units_sold_all", "line_code_series", "line_daily_summary", "line_price_changes",
    "line_discounted_items", "line_new_lows", "line_duplicate_titles",
]


def run(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.build(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in sys.argv[1:] or HEADLINE:
        run(spark, key, sf_dir)
        times[key] = round(statistics.median(run(spark, key, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
