"""Time the headline queries and print one JSON line.

Each query is evaluated once, in full, into Spark's no-op sink; a first untimed query starts
the session. Settings: ``BENCH_SF_DIR`` and ``BENCH_CPUS``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from catalog.queries import QUERIES

HEADLINE = [
    "dataset_audit_unlabelled",
    "missing_values",
    "rates_by_attribute",
    "gap_summary",
    "prediction_audit",
    "prediction_audit_multi",
    "compare_fairness",
    "stratified_split",
    "ffill_bfill",
    "scale_by_group",
    "label_encode",
    "standard_scale",
    "group_stats",
    "group_covariance",
    "repair_mean",
    "repair_mean_two_attrs",
    "repair_covariance",
    "repair_multivariate_noise",
    "reweighing",
    "fit_group_thresholds",
    "threshold_predict",
    "baseline_model_audit",
    "fair_dp",
    "fair_thresholds_audit",
    "fairness_run_reports",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evenhand-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in sys.argv[1:] if n in QUERIES] or HEADLINE
    QUERIES["dataset_shape"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
