"""Headline queries on $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""

import json
import os
import sys
import time

from bondscope.queries import QUERIES
from bondscope.session import local_session

HEADLINES = (
    "lot_view", "widened", "ground_truth", "several_lots", "newest_lineitems", "error_metrics",
    "key_check_of_lines", "standardised", "outlier_rows", "column_drift", "column_profile",
    "dataset_summary", "datetime_parts", "one_hot", "hash_split", "exact_split",
    "stored_predictions", "regression",
)
RUNS = 2


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINES
    seconds(spark, "lot_view", folder)  # the first query pays for the start of the session
    times = {name: round(min(seconds(spark, name, folder) for _ in range(RUNS)), 3) for name in chosen}
    print(json.dumps({
        "metric": "best of two runs in seconds, sum over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
