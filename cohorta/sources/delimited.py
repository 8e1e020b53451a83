"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import ColumnRule
from cohorta.functions.scalars import normalize_name, normalize_names

# Fixed value: file name of a numbered sample run.
RUN_FILE = "[0-9][0-9][0-9][0-9]_sample_predictions.csv"


def read_scored_csv(spark: SparkSession, path: str, rules: Sequence[ColumnRule] = ()) -> DataFrame:
    """CSV with normalised names; declared columns get their type, the rest stays text."""
    df = normalize_names(spark.read.csv(path, header=True))
    typed = {rule.name: rule.typed() for rule in rules if rule.name in df.columns}
    return df.withColumns(typed) if typed else df


def read_raw_csv(
    spark: SparkSession,
    path: str,
    key_column: str | None = None,
    drop_columns: Sequence[str] = (),
    rules: Sequence[ColumnRule] = (),
) -> DataFrame:
    """CSV without the named columns and without rows that are empty apart from the key.

    Columns are text unless contract rules are given; then a value the type rejects becomes
    null. Leave the rules out where validation should see, and report, the raw text. No second
    pass over the file infers types.
    """
    df = normalize_names(spark.read.csv(path, header=True))
    unwanted = {normalize_name(name) for name in drop_columns}
    df = df.drop(*[name for name in df.columns if name in unwanted])
    key = normalize_name(key_column) if key_column else None
    content = [name for name in df.columns if name != key]
    df = df.dropna("all", subset=content)
    typed = {rule.name: rule.typed() for rule in rules if rule.name in df.columns}
    return df.withColumns(typed) if typed else df


def read_run_files(spark: SparkSession, folder: str) -> DataFrame:
    """All numbered sample runs of a folder as one table with ``run_id``; one job, no loop.

    A run is a plain file or the part-file folder Spark writes. No run gives an empty table.
    """
    try:
        df = spark.read.csv(f"{folder.rstrip('/')}/{RUN_FILE}", header=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "run_id string")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4})_sample_predictions\.csv", 1)
    return df.withColumn("run_id", number)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_report(report: DataFrame, folder: str, source_analysis: str) -> str:
    """The report as CSV with four decimals, named after the analysis source.

    A report has one row per version and period, so a single part keeps its order.
    """
    path = f"{folder.rstrip('/')}/monitoring_summary_{source_analysis}"
    fixed = [
        F.format_string("%.4f", F.col(name)).alias(name) if kind == "double" else F.col(name)
        for name, kind in report.dtypes
    ]
    report.select(
        *[
            F.when(F.col(name).isNotNull(), column).alias(name) if kind == "double" else column
            for (name, kind), column in zip(report.dtypes, fixed)
        ]
    ).coalesce(1).write.mode("overwrite").csv(path, header=True)
    return path
