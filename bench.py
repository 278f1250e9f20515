"""Times the headline queries: one warm-up, then the median of three runs, every row computed."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabweave.catalog import queries  # noqa: E402

HEADLINES = (
    "s1_csv_scan",
    "p5_one_hot",
    "p6_assemble",
    "x1_seeded_shuffle",
    "x2_three_way_split",
    "x3_running_totals",
    "a1_fit_scaling",
    "a1_exact_median",
    "a5_class_weights",
    "prepared_table",
    "split_summary",
    "m1_score_mlp",
    "m9_train_epoch",
    "m10_validation_epoch",
    "m12_early_stop",
    "m14_logistic_baseline",
    "evaluate_classification",
    "evaluate_regression",
    "e11_precision_recall_curve",
    "e12_best_f1",
    "h1_latest_runs",
    "h4_evolution_of_all",
    "h9_report",
)
RUNS = 3


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    times = {}
    for name in HEADLINES:
        seconds(known[name], spark, sf_dir)
        times[name] = round(statistics.median(seconds(known[name], spark, sf_dir) for _ in range(RUNS)), 4)
    spark.stop()
    total = round(sum(times.values()), 4)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
