"""Times the headline queries and prints one JSON line.

Every query is run once to warm up, then ``BENCH_RUNS`` times; its time is the median. A run builds the
plan, including any files it writes, and carries out the result without collecting it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fareloom.catalog import QUERIES
from fareloom.session import build_session

HEADLINES = [
    # scans, filters, counts
    "scan_project", "segment_counts", "longest_trip_day", "top_pickup_zones", "largest_tip_zone",
    "trips_on_day", "trip_hours", "count_distinct_pickup", "least_frequent_zone", "recent_trips",
    # staging, facts, marts
    "dedup_first", "row_hash", "stage_trips", "fact_trips", "dim_fhv_trips", "monthly_zone_revenue",
    "quarterly_revenue_yoy", "monthly_fare_percentiles", "fare_percentile_window",
    "route_duration_p90", "nth_longest_route",
    # activity
    "event_type_counts", "top_users", "top_repos", "daily_events", "watch_counts", "sessions_batch",
    # checks, merges, tables, streams
    "check_unique", "check_relationships", "quality_report", "merge_insert_only", "merge_upsert",
    "partition_prune_distinct", "csv_declared", "json_pages", "stream_sessions", "tumbling_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for key in wanted:
        once(key)
        times[key] = round(statistics.median(once(key) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
