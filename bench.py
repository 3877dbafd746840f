"""Time the headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; print one JSON line.

Each query is built and run to completion with a no-op sink (``write.format("noop")``),
so the whole plan executes without collecting rows to the driver. One warm-up run of
the flagship query comes first (JVM start, code generation); each query is then timed
$BENCH_REPEATS times (default 3), from building the DataFrame to the end of the run,
and its median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "island_summary",
    "island_bounds",
    "neighbour_flow",
    "job_backfill",
    "job_consolidate",
    "job_repair_seam",
    "job_incremental",
    "dedupe_same_start",
    "range_delete",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from flowruns.plans.catalog import build
    from flowruns.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="flowruns-bench")
    qs = build()
    qs["island_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "stat": f"median of {repeats}"}))
    spark.stop()


if __name__ == "__main__":
    main()
