"""Jobs that bring raw files into month-partitioned datasets."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from cohorta.contracts import UseCase
from cohorta.functions.scalars import utc_naive
from cohorta.operators.sampling import DEFAULT_SEED, assign_balanced, date_spine
from cohorta.operators.validation import validate
from cohorta.sources.delimited import read_raw_csv, read_run_files, write_csv
from cohorta.sources.events import event_schema, read_event_lines, write_malformed
from cohorta.sources.monthly import write_monthly


def prepare_data(spark: SparkSession, csv_path: str, dataset: str, use_case: UseCase) -> None:
    """Raw CSV to a validated monthly dataset."""
    rows = validate(read_raw_csv(spark, csv_path), use_case)
    write_monthly(rows, dataset, use_case.time_column, overwrite_partitions=True)


def ingest_events(
    spark: SparkSession, log: str, dataset: str, use_case: UseCase, strict: bool = False
) -> None:
    """JSON event log to a monthly dataset; the months in the log are replaced.

    Malformed lines, unreadable times included, are written as text to ``malformed_folder`` of the
    log. ``strict`` ingests nothing at all if there are any.
    """
    time = use_case.time_column
    events, malformed = read_event_lines(spark, log, event_schema(use_case), time)
    write_malformed(malformed, malformed_folder(dataset, log))
    if strict and not malformed.isEmpty():
        return
    stamped = events.withColumn(time, utc_naive(events[time]))
    write_monthly(stamped, dataset, time, overwrite_partitions=True)


def malformed_folder(dataset: str, log: str) -> str:
    """Where the malformed lines of a log go: beside the dataset, one folder for each path of a log."""
    path = log.rstrip("/")
    name = re.sub(r"[^A-Za-z0-9._-]+", "_", path.rsplit("/", 1)[-1])
    return f"{dataset.rstrip('/')}-malformed/{name}-{hashlib.md5(path.encode()).hexdigest()}"


def ingest_runs(spark: SparkSession, folder: str, dataset: str, use_case: UseCase) -> None:
    """Numbered sample-run files to a validated monthly dataset."""
    rows = validate(read_run_files(spark, folder), use_case)
    write_monthly(rows, dataset, use_case.time_column, overwrite_partitions=True)


def with_reference_dates(
    df: DataFrame,
    start: str,
    end: str,
    column: str,
    key: str,
    step: str = "1 month",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Spread the rows evenly over the period starts in [start, end]."""
    dates = [row[0] for row in date_spine(df.sparkSession, start, end, step).collect()]
    dated = assign_balanced(df, dates, column, key, seed)
    return dated.withColumn(column, dated[column].cast("timestamp_ntz"))


def add_reference_dates(
    spark: SparkSession,
    source: str,
    target: str,
    start: str,
    end: str,
    use_case: UseCase,
    step: str = "1 month",
    date_column: str | None = None,
    key: str | None = None,
) -> None:
    """Raw CSV to a validated CSV with an evenly assigned date column; the key identifies a row."""
    row_key = key or use_case.key_column
    if row_key is None:
        raise ValueError("A row key is needed to assign dates reproducibly.")
    rows = validate(read_raw_csv(spark, source), use_case)
    dated = with_reference_dates(
        rows, start, end, date_column or use_case.time_column, row_key, step
    )
    write_csv(dated, target)
