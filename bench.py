"""Seconds per headline query: one warm-up, then the median of three timed runs.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitepulse.catalog import QUERIES  # noqa: E402
from sitepulse.session import build_session  # noqa: E402

HEADLINE = [
    "sla_daily_site", "sla_near_violation", "penalty_consolidation", "penalty_trend",
    "slot_counts_motion", "site_online_pct", "video_availability_daily", "vod_daily",
    "footage_status", "outage_patterns", "repeated_disk_faults", "disk_tickets_new",
    "sensor_matrix", "sensor_priority", "site_features", "dashboard_counts",
    "latest_per_key", "dedupe_business_key", "pct_rank_orders", "interval_stab",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
