"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Results go to a sink that keeps
nothing, so the time is that of the query and not of moving rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.session import local_session
from workload import registry
from workload.families import load

HEADLINE = (
    "e07_top_k",
    "e08_threshold_sweep",
    "e10_points_on_test",
    "c07_clean_chain",
    "v07_full_validation",
    "f01_row_index",
    "f14_feature_chain",
    "t07_prepared_transfers",
    "a28_alert_features",
    "a28_short_groups",
    "a28_large_alerts",
    "p03_medians",
    "d04_column_verdicts",
    "x03_top_factors",
    "x06_global_importance",
    "k01_correlations",
    "q01_review_queue",
    "m04_scored_table",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = local_session("riskloom-bench", cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    load()
    spark.read.parquet(f"{folder}/orders.parquet").count()  # starts the executors
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
