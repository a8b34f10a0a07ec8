"""Headline queries at one scale factor; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline set). Each query runs once
to warm up, which also lands its derived inputs as parquet, then twice; the better time
counts. Results go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from trunkline.plans.registry import queries
from trunkline.session import local_session

HEADLINE = [
    "scan_portability",
    "normalize_number",
    "normalize_pair",
    "both_valid",
    "classify_call",
    "dedup_portability",
    "upsert_history",
    "history_table",
    "carriers_from_portability",
    "upsert_carriers",
    "consolidate_plan",
    "range_join_plan",
    "asof_single_date",
    "asof_per_call",
    "resolve_carriers",
    "carrier_change",
    "enrich_cdr",
    "load_portability",
    "load_numbering",
    "query_numbers_carriers",
]


def measure(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(
        "trunkline-bench",
        cpus,
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds = {}
    for name in names:
        measure(spark, registered[name], sf_dir)  # warm-up: inputs, code generation
        runs = [measure(spark, registered[name], sf_dir) for _ in range(2)]
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
