"""Times the headline queries on the shared tables and prints one JSON line.

BENCH_SF_DIR   folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_QUERIES  comma-separated names (default: the list below)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetpulse.plans.queries import QUERIES  # noqa: E402
from fleetpulse.session import local_session  # noqa: E402

HEADLINE = [
    "critical_equipment_report",
    "critical_faults",
    "last_gps",
    "decode_payload",
    "validate_gps",
    "split_valid_rejected",
    "batch_summary",
    "rejections_by_reason",
    "dedup_batch",
    "normalize_maintenance",
    "validate_maintenance",
    "ingest_summary",
    "fleet_status",
    "alert_payload",
    "signal_loss_sessions",
    "dq_metrics",
    "dq_failure_cases",
    "dq_column_status",
    "windowed_threshold_alarm",
    "windowed_threshold_alarm_p99",
    "maintenance_kpis",
]


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds from building the query to the last row computed."""
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "fleetpulse-bench", memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)  # compile and warm the file cache
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
