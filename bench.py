"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import time

from cohorta.session import build_session

HEADLINE = [
    "base_summary",
    "realized_metrics",
    "operational_summary",
    "monitoring_report",
    "service_report",
    "js_drift_categorical",
    "js_drift_continuous",
    "cbpe_estimates",
    "reconstruction_drift",
    "roc_auc",
    "average_precision",
    "max_f1_threshold",
    "evaluation_row",
    "calibration_curve",
    "model_comparison",
    "contract_violations",
    "quarantine_reasons",
    "engineered_features",
    "balanced_assignment",
    "stratified_split",
    "profile_numeric",
    "correlation_long",
    "incidence_deciles",
    "monthly_write_read",
    "flatten_event_features",
    "temporal_folds",
    "imputed_scaled",
    "train_lr_score",
    "batch_score_rule",
    "weighted_scores",
    "stream_ingest",
    "stream_scored",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from registered import collect

    registered = collect("QUERIES")
    registered["base_summary"](spark, sf_dir).count()  # start-up and code generation
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
