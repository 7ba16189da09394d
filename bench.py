"""Times the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores),
BENCH_RUNS (timed runs per query, after one warm-up), BENCH_ALL=1 (every
registered query). A query's time covers everything it writes and reads,
and its whole result, which goes to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from parampipe.plans import registry
from parampipe.session import build_session

HEADLINE = [
    "extract_month",
    "extract_month_range",
    "extract_two_params",
    "extract_by_month_key",
    "extract_case_totals",
    "csv_gz_roundtrip",
    "parquet_roundtrip",
    "typed_convert",
    "incremental_by_suffix",
    "incremental_by_hash",
    "stream_incremental_load",
    "replace_partitions",
    "keep_latest_n",
    "pending_cases",
    "slow_top10",
    "rows_per_case",
    "content_fingerprint",
    "lint_report",
    "natural_prefix_order",
    "sql_step_chain",
    "extract_load_report",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(registry.QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
