"""Table of training runs: one nested record per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.sources.commits import append_commit

# Layout and version of the run record.
SCHEMA_VERSION = 3
RUN_SCHEMA = """
schema_version int,
run struct<id: string, name: string>,
model struct<use_case: string, name: string, version: int,
             reference: struct<uri: string, model_id: string>>,
data struct<target_column: string, time_column: string,
            split: struct<name: string, metadata: map<string, string>>>,
training struct<classifier: struct<name: string, alias: string>,
                features: struct<count: int, names_in: array<string>, names_out: array<string>>,
                tuning: struct<enabled: boolean>, n_jobs: int,
                calibration: struct<method: string>,
                threshold: struct<strategy: string, selected_on: string, value: double>>,
evaluation struct<metrics: map<string, double>>,
lifecycle struct<registration: struct<enabled: boolean>,
                 promotion: struct<enabled: boolean, decision: struct<
                   candidate_score: double, champion_score: double, score_delta: double,
                   min_delta: double, promote: boolean, reason: string>>>,
parameters map<string, string>,
tags map<string, string>
"""
REQUIRED = (
    "schema_version",
    "run.id",
    "run.name",
    "model.use_case",
    "model.name",
    "model.reference",
    "data.target_column",
    "data.time_column",
    "data.split.name",
    "data.split.metadata",
    "training.classifier.name",
    "training.classifier.alias",
    "training.features.count",
    "training.features.names_in",
    "training.features.names_out",
    "training.tuning.enabled",
    "training.n_jobs",
    "training.calibration.method",
    "training.threshold.strategy",
    "training.threshold.selected_on",
    "training.threshold.value",
    "evaluation.metrics",
    "lifecycle.registration.enabled",
    "lifecycle.promotion.enabled",
    "lifecycle.promotion.decision",
)


def _rules() -> dict[str, Column]:
    """Rule name to the condition that is true on a broken record."""
    broken = {f"{path} is missing": F.col(path).isNull() for path in REQUIRED}
    broken["schema_version is unsupported"] = F.col("schema_version") != SCHEMA_VERSION
    jobs = F.col("training.n_jobs")
    broken["n_jobs is invalid"] = (jobs == 0) | (jobs < -1)
    broken["a metric has no value"] = F.exists(
        F.map_values("evaluation.metrics"), lambda v: v.isNull()
    )
    for path in ("training.features.names_in", "training.features.names_out"):
        broken[f"{path} holds a null"] = F.exists(path, lambda name: name.isNull())
    return broken


def check_runs(runs: DataFrame) -> DataFrame:
    """The table itself when every record is valid; one aggregate over all rules."""
    rules = _rules()
    counted = runs.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(rules.values())])
    found = counted.first()
    broken = {name: found[f"c{i}"] for i, name in enumerate(rules) if found[f"c{i}"]}
    if broken:
        raise ValueError(f"Invalid run records: {broken}.")
    return runs


def read_runs(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Run records; a value of the wrong type or a broken line fails the read."""
    runs = spark.read.schema(RUN_SCHEMA).option("mode", "FAILFAST").json(path)
    return check_runs(runs) if check else runs


def append_run(spark: SparkSession, path: str, record: dict) -> None:
    """Add one record; jobs that add records at the same time do not meet."""
    append_commit(spark, path, check_runs(spark.createDataFrame([record], RUN_SCHEMA)))


def append_monitoring_run(
    report: DataFrame, folder: str, experiment: str, run_name: str, tags: dict[str, str]
) -> None:
    """Attach a written report with its cohort and model tags to the monitoring runs."""
    labels = F.create_map(*[F.lit(x) for pair in sorted(tags.items()) for x in pair]) if tags else F.create_map()
    report.select(
        F.lit(experiment).alias("experiment"),
        F.lit(run_name).alias("run_name"),
        labels.cast("map<string,string>").alias("tags"),
        F.struct(*report.columns).alias("summary"),
    ).write.mode("append").json(f"{folder.rstrip('/')}/monitoring_runs")
