"""Time the headline queries and print one JSON line.

Reads the tables in $BENCH_SF_DIR on local[$BENCH_CPUS]. Each query is run to the end into
a sink that keeps nothing, after one unmeasured run of the whole list at the smallest
scale that only warms the JVM up.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tallyguard.plans.catalog import QUERIES
from tallyguard.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_UP = "/root/testdata/sf0.001"
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "suspicious_transactions",
    "clean_transactions",
    "clean_repeated_keys",
    "quality_report",
    "plant_fraud",
    "prev_features",
    "prev_features_hot",
    "velocity_features",
    "velocity_features_hot",
    "history_features",
    "history_features_hot",
    "account_features",
    "write_by_day",
    "feature_vectors",
    "train_logistic_korean",
    "train_boosted",
    "train_boosted2",
    "encode_target",
    "threshold_sweep",
    "auc",
    "runs_table",
    "best_run",
    "score_logistic",
    "batch_score",
    "prepare",
    "prepare_by_periods",
    "prepare_train_score",
    "score_stream",
    "prev_stream",
    "velocity_stream",
    "account_stream",
    "alerts",
    "alerts_stream",
    "quality_report_days",
]


def main() -> None:
    spark = build_session(
        app="bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        run(name, WARM_UP)
    seconds = {name: run(name, FOLDER) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
