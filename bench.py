"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query is run to completion (all rows, all columns) into a sink that discards them. BENCH_WARMUP
untimed passes over all queries (default 1) let the JVM compile; then the best of BENCH_RUNS timed runs
(default 1) is reported.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from workload import registry

HEADLINE = (
    "basic_stat", "basic_stat_cat", "period_stat", "max_min_diff", "last_mean_diff", "div", "div_min_max",
    "date_gaps", "row_gaps", "shift", "lag_diff", "important_cross", "important_mix32", "avg_max_last", "last_row",
    "all_families", "target_profile", "value_counts", "label_encode", "mode_impute", "default_metric",
    "default_metric_int_cutoff", "roc_auc", "calibration", "stratified_folds", "stratified_sample",
    "ensemble_avg", "pseudo_label", "assemble_features", "population_train_vs_private", "cv_scores",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    shared = tempfile.TemporaryDirectory(prefix="panelwise-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared.name)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    chosen = names or HEADLINE
    for _ in range(warmup):
        for n in chosen:
            run(n)
    seconds = {n: round(min(run(n) for _ in range(runs)), 3) for n in chosen}
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
                "warmup": warmup,
                "runs": runs,
            }
        )
    )
    spark.stop()
    shared.cleanup()


if __name__ == "__main__":
    main(sys.argv[1:])
