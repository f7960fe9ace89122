"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from clickloom.workload import QUERIES  # noqa: E402
from tests.session import local_session  # noqa: E402

HEADLINE = (
    "affinity_topk",
    "affinity_parts",
    "affinity_domains",
    "profile_mart",
    "split_events_rows",
    "hourly_kpis",
    "hourly_kpis_stream",
    "users_items_long",
    "users_items_wide",
    "matrix_merge",
    "users_items_update",
    "time_features",
    "domain_vector",
    "feature_matrix",
)


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        samples = [timed(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(samples), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
