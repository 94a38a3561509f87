"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS`` (5)
timed runs, each forcing the whole result through the ``noop`` sink, with the
cache cleared before every run.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from overspend.plans.catalog import QUERIES  # noqa: E402
from overspend.session import local_session  # noqa: E402

HEADLINE = ["scored", "duplicates", "volume_spikes", "all_flags", "executive_summary", "scored_ranked"]


def run_once(spark, name: str, sf_dir: str) -> float:
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    shared = tempfile.TemporaryDirectory(prefix="overspend-bench-")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="overspend-bench", checkpoint_dir=shared.name)
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": sf,
                "runs": runs,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
