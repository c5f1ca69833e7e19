"""Seconds per headline query, printed as one JSON line.

Each query runs once to warm up, then BENCH_RUNS times; its median counts. Rows are computed in
full and written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.compare import session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINES = (
    "typed_projection",
    "api_flatten",
    "clean_statistics",
    "job_counts",
    "category_join",
    "trending_analytics",
    "channel_analytics",
    "category_analytics",
    "rank_in_group",
    "dq_verdict",
    "csv_source",
    "raw_landing",
    "incremental_silver",
    "gated_gold",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINES
    spark = session(cores)
    taken = {}
    for name in chosen:
        seconds(spark, name, folder)
        taken[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name}: {taken[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries, warm",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
