"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortloom.session import build_session  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "scan_lookback",
    "feat_count",
    "feat_avg",
    "feat_wide",
    "sink_by_date",
    "validation_report",
    "run_stage",
    "split_summary",
    "split_last_month",
    "drift_months",
    "ks_stat",
    "shifting_features",
    "final_features",
    "monthly_performance",
    "confusion_best_f1",
    "cv_summary",
    "latest_per_key",
    "best_run",
    "feature_importance",
    "split_gains",
    "class_balance",
    "permutation_drops",
    "stacked_model",
)
# The same search again, timed on request: python bench.py train_leaderboard varimp batch_predict run_pipeline


def run(query, spark) -> float:
    started = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["monthly_stats"], spark)  # start-up is not part of any query
    only = sys.argv[1:] or HEADLINES
    times = {name: round(run(QUERIES[name], spark), 3) for name in only}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
