"""Time the headline queries, each twice; prints one JSON line.

value and queries are of the second runs, first_run is of the first.

BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local cores            (default 8)
BENCH_QUERIES  comma-separated names  (default: the headline list; "all" for every query)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from exercises.queries import REGISTRY  # noqa: E402
from strataflow.session import build_session  # noqa: E402

HEADLINE = [
    "dedup_latest",
    "silver_accepted",
    "weather_hourly",
    "hourly_join",
    "scd2_history",
    "asof_join",
    "asof_join_window",
    "fact_build",
    "trip_report",
    "star_query",
    "merge_upserts",
    "silver_incremental",
    "archive_scan",
    "check_unique",
    "check_relationships",
    "sql_guard_audit",
    "vector_topk",
    "vector_topk_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE if not chosen else list(REGISTRY) if chosen == "all" else chosen.split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    first, seconds = {}, {}
    for name in names:
        for took in (first, seconds):  # the second run is free of compilation
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
