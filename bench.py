"""Times the headline queries and prints one JSON line.

The driver's tables come as one file with one row group each, which is one task. They are
landed once, before the clock starts, with one file per core, as a cluster would hold them;
the queries are the same on either. Each query runs once to warm up and three times more;
the median counts. Rows go to a sink that discards them, so all columns of all rows are
computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seepline.session import fresh_path, local_session  # noqa: E402
from suite import registry  # noqa: E402

HEADLINE = [
    "location_summary", "flag_inwqx", "to_upload", "result_activity", "pivot_samples", "unpivot_field",
    "match_station_rules", "match_station_rules_by_row", "clean_results", "state_lab_job", "charge_balance",
    "piper_xy", "ros_impute",
]


TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem"]


def landed(spark, folder: str, files: int) -> str:
    root = fresh_path(spark, "bench")
    for table in TABLES:
        spark.read.parquet(f"{folder}/{table}.parquet").repartition(files).write.parquet(f"{root}/{table}.parquet")
    return root


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    folder = landed(spark, folder, int(cores))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    took = {}
    for key in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[key](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[key] = round(statistics.median(times[1:] or times), 3)
        print(key, took[key], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": name,
            }
        )
    )


if __name__ == "__main__":
    main()
