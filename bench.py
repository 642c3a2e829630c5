"""Times the headline queries and prints one JSON line.

Each query is planned and run to a no-op sink, so every row is computed and none is sent to the
driver. After one warm-up the median of BENCH_RUNS runs is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import pyspark

from tidemark.plans.catalog import queries
from tidemark.session import local_session

HEADLINE = (
    "funnel",
    "order_outcomes",
    "order_rollup",
    "payment_rollup",
    "zip_centroid",
    "orders_analytical",
    "asof_seller",
    "asof_route",
    "snapshot_sizes",
    "attach_history",
    "leaky_vs_correct",
    "inflight_vs_resolved",
    "review_impact",
    "ts_folds",
    "interleaved_split",
    "pr_auc",
    "metric_summary",
    "threshold_sweep",
    "reliability_bins",
    "blend_grid",
    "feature_matrix",
    "serving_matrix",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session("tidemark-bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def timed(name: str) -> float:
        started = time.perf_counter()
        registered[name](spark, directory).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in chosen:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "spark": pyspark.__version__,
                "cores": cores,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
