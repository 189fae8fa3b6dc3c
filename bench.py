"""Headline queries on one machine; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tenurelens.plans import fitted  # noqa: F401  (registers its queries)
from tenurelens.plans.queries import QUERIES

HEADLINES = [
    "feature_matrix", "churn_label", "quality_report", "quarantine", "counting_process",
    "km_by_segment", "km_ci", "logrank_multi", "baseline_breslow", "score_table", "cox_fit",
    "cox_tvc_fit", "aft_comparison", "c_index", "auc_horizon", "integrated_brier", "drift_report",
    "batch_drift", "perf_history", "cross_validate", "cox_fit_matrix", "drift_features",
    "cox_stratified_fit", "survival_at_own_time",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        # call-site capture costs a few milliseconds per Column operation
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINES:
        begin = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
