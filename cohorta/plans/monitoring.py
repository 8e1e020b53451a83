"""Monitoring front ends: files, datasets, and the record of a finished report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohorta.contracts import UseCase
from cohorta.plans.report import build_report
from cohorta.sources.delimited import read_scored_csv, write_report
from cohorta.sources.events import PREDICTION, PREDICTION_ERROR, load_events
from cohorta.sources.monthly import read_monthly
from cohorta.sources.runs import append_monitoring_run


def with_contract_time(df: DataFrame, use_case: UseCase, dataset_time: str | None) -> DataFrame:
    """Rename a dataset's own time column when the contract's one is absent."""
    if dataset_time and dataset_time != use_case.time_column and use_case.time_column not in df.columns:
        return df.withColumnRenamed(dataset_time, use_case.time_column)
    return df


def monitor_files(
    spark: SparkSession,
    reference_csv: str,
    use_case: UseCase,
    analysis_csv: str | None = None,
    prediction_log: str | None = None,
    error_log: str | None = None,
    output_folder: str | None = None,
    model_version: int | None = None,
    malformed_folder: str | None = None,
    **options,
) -> DataFrame:
    """Report from files: exactly one of a scored CSV and a prediction log.

    Malformed lines of the logs go to folders named after the kind of event, below ``malformed_folder`` or
    else the output folder; without either they are left out.
    """
    if (analysis_csv is None) == (prediction_log is None):
        raise ValueError("Give exactly one of a scored CSV and a prediction log.")
    if error_log is not None and prediction_log is None:
        raise ValueError("An error log belongs to a prediction log.")
    reference = read_scored_csv(spark, reference_csv, use_case.rules)
    source = "batch" if analysis_csv is not None else "api"
    errors = None
    if analysis_csv is not None:
        analysis = read_scored_csv(spark, analysis_csv, use_case.rules)
    else:
        broken = malformed_folder or (output_folder and f"{output_folder.rstrip('/')}/malformed")
        analysis, errors = (
            load_events(spark, log, kind, use_case, malformed_to=broken and f"{broken.rstrip('/')}/{kind}")
            if log is not None
            else None
            for log, kind in ((prediction_log, PREDICTION), (error_log, PREDICTION_ERROR))
        )
    report = build_report(
        reference, analysis, use_case, "batch", source,
        errors=errors, model_version=model_version, **options,
    )
    if output_folder is not None:
        write_report(report, output_folder, source)
    return report


def monitor_datasets(
    spark: SparkSession,
    reference: str | None,
    analysis: str | None,
    use_case: UseCase,
    dataset_time: str | None = None,
    errors: str | None = None,
    start=None,
    end=None,
    source_analysis: str = "batch",
    **options,
) -> DataFrame:
    """Report from monthly datasets: both cohorts, optionally failed requests."""
    if reference is None or analysis is None:
        raise ValueError("Both datasets are needed.")
    time = dataset_time or use_case.time_column

    def load(path: str, first=None, last=None) -> DataFrame:
        return with_contract_time(read_monthly(spark, path, time, first, last), use_case, dataset_time)

    return build_report(
        load(reference),
        load(analysis, start, end),
        use_case,
        "batch",
        source_analysis,
        errors=load(errors, start, end) if errors is not None else None,
        **options,
    )


def record_report(
    report: DataFrame, store: str, use_case: UseCase, run_name: str, tags: dict[str, str]
) -> None:
    append_monitoring_run(report, store, f"{use_case.name}-monitoring", run_name, tags)
