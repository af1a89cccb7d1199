"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_PARTITIONS (shuffle partitions, default 2 x cpus), BENCH_WARM_DIR.
Each query is executed in full through the ``noop`` sink (nothing is
collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = [
    "word_count",
    "top_words",
    "parse_access_log",
    "daily_requests_per_host",
    "not_found_by_hour",
    "tfidf",
    "scalable_similarity",
    "gold_evaluation",
    "threshold_sweep",
    "item_count_avg",
    "top_rated",
    "select_rank",
]


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    partitions = int(os.environ.get("BENCH_PARTITIONS", str(2 * cpus)))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=partitions, app_name="tessera-bench")
    # Warm-up outside the timings: one pass of the same queries over the
    # smallest data set, so the timed run measures steady-state throughput
    # (JIT-compiled code), as on a long-running cluster.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != data_dir:
        for name in HEADLINE:
            catalog.run(name, spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.run(name, spark, data_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(data_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
