"""Out-of-time train and test sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import UseCase
from cohorta.functions.scalars import is_date_only, normalize_names
from cohorta.operators.validation import validate
from cohorta.sources.monthly import read_monthly

SIDES = ("train", "test")


def with_split(df: DataFrame, time_column: str, split_date) -> DataFrame:
    """Add ``split``: train before the split date, test from it on."""
    before = F.col(time_column).cast("timestamp_ntz") < F.lit(str(split_date)).cast("timestamp_ntz")
    return df.withColumn("split", F.when(before, "train").otherwise("test"))


def split_metadata(marked: DataFrame, time_column: str) -> DataFrame:
    """One row: row count, first and last moment of either side; one aggregate."""
    columns = []
    for side in SIDES:
        here = F.col("split") == side
        columns += [
            F.count_if(here).alias(f"{side}_rows"),
            F.min(F.when(here, F.col(time_column))).alias(f"{side}_start"),
            F.max(F.when(here, F.col(time_column))).alias(f"{side}_end"),
        ]
    return marked.agg(*columns)


def metadata_text(metadata: DataFrame) -> DataFrame:
    """ISO-8601 form of the bounds, columns in name order."""
    iso = {
        name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
        for name, kind in metadata.dtypes
        if kind.startswith("timestamp")
    }
    return metadata.withColumns(iso).select(*sorted(metadata.columns))


def check_bounds(start, split, end) -> None:
    first, cut, last = (dt.datetime.fromisoformat(str(b)) for b in (start, split, end))
    if first >= cut:
        raise ValueError("The split date must lie after the start date.")
    if cut > last:
        raise ValueError("The split date must not lie after the end date.")


def create_split(
    spark: SparkSession,
    dataset: str,
    time_column: str,
    start,
    split,
    end,
    folder: str,
    name: str = "default",
    exact_end: bool = False,
    json_metadata: bool = True,
) -> dict:
    """Write both sides of a date range and return the split metadata.

    A date-only end covers its whole day; ``exact_end`` stops at midnight instead. Both sides
    are written in one pass, below ``<folder>/<name>/split=train`` and ``split=test``.
    """
    check_bounds(start, split, end)
    last = f"{end} 00:00:00" if exact_end and is_date_only(str(end)) else end
    marked = with_split(
        read_monthly(spark, dataset, time_column, str(start), str(last)), time_column, split
    ).drop("year", "month")
    metadata = split_metadata(marked, time_column)
    found = metadata.first().asDict()
    for side in SIDES:
        if not found[f"{side}_rows"]:
            raise ValueError(f"The {side} side of the split holds no rows.")
    target = f"{folder.rstrip('/')}/{name}"
    marked.write.partitionBy("split").mode("overwrite").parquet(target)
    if json_metadata:
        one_row = spark.createDataFrame([found], metadata.schema)
        metadata_text(one_row).coalesce(1).write.mode("overwrite").json(f"{target}-metadata")
    return found


def read_split(
    spark: SparkSession, folder: str, name: str, use_case: UseCase
) -> tuple[DataFrame, DataFrame]:
    """(train, test), both validated against the contract."""
    whole = spark.read.parquet(f"{folder.rstrip('/')}/{name}")
    sides = [
        validate(normalize_names(whole.where(F.col("split") == side).drop("split")), use_case)
        for side in SIDES
    ]
    return sides[0], sides[1]


def read_split_metadata(spark: SparkSession, folder: str, name: str) -> dict[str, str]:
    row = spark.read.json(f"{folder.rstrip('/')}/{name}-metadata").first()
    found = row.asDict() if row else {}
    needed = {f"{side}_{part}" for side in SIDES for part in ("rows", "start", "end")}
    absent = sorted(needed - set(found))
    if absent:
        raise ValueError(f"Split metadata lacks {', '.join(absent)}.")
    return {key: str(value) for key, value in found.items()}
