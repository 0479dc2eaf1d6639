"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from faultline.plans import QUERIES
from faultline.session import drop_written, local_session

HEADLINE = [
    "daily_activity", "prune_columns", "prof_missing", "agg_corr_matrix", "agg_describe", "agg_histogram",
    "pipe_filter_and_fill", "join_asof_general", "win_rolling_rows", "win_rolling_days", "split_stratified",
    "feat_hybrid_onehot", "pipe_model_table", "pipe_training_table", "imp_knn_gap", "imp_ridge_dmin", "ml_ols",
    "ml_tree_root_split", "fc_recursive", "st_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # JVM and reader warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_written(spark)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
