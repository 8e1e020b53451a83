"""Month-partitioned Parquet datasets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.functions.scalars import month_number, require_columns, time_between

YEAR, MONTH = "year", "month"


def with_month(df: DataFrame, time_column: str) -> DataFrame:
    require_columns(df, [time_column], "dataset")
    moment = F.col(time_column).cast("timestamp_ntz")
    return df.withColumns(
        {time_column: moment, YEAR: F.year(moment), MONTH: F.month(moment)}
    )


def balanced_by_month(df: DataFrame) -> DataFrame:
    """Rows of a month together in few files; a month far larger than the others is split.

    The rebalance hint leaves the split to adaptive execution, which knows the real sizes, so
    one hot month is not one task.
    """
    return df.hint("rebalance", F.col(YEAR), F.col(MONTH))


def write_monthly(
    df: DataFrame, path: str, time_column: str, overwrite_partitions: bool = False
) -> None:
    """Append to the dataset, or replace exactly the months present in the input."""
    rows = with_month(df, time_column)
    if rows.limit(1).isEmpty():
        return
    writer = balanced_by_month(rows).write.partitionBy(YEAR, MONTH)
    if overwrite_partitions:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def _as_moment(bound) -> dt.datetime:
    if isinstance(bound, dt.datetime):
        return bound
    if isinstance(bound, dt.date):
        return dt.datetime(bound.year, bound.month, bound.day)
    return dt.datetime.fromisoformat(str(bound))


def month_keys(start, end) -> list[tuple[int, int]]:
    """Every (year, month) the range touches."""
    low, high = _as_moment(start), _as_moment(end)
    if low > high:
        raise ValueError("The start lies after the end.")
    first, last = low.year * 12 + low.month - 1, high.year * 12 + high.month - 1
    return [(number // 12, number % 12 + 1) for number in range(first, last + 1)]


def month_predicate(start, end) -> Column:
    """Condition on the partition columns, so that untouched months are never listed or read."""
    keys = month_keys(start, end)
    low, high = keys[0], keys[-1]
    number = month_number(F.col(YEAR), F.col(MONTH))
    return (number >= low[0] * 100 + low[1]) & (number <= high[0] * 100 + high[1])


def read_monthly(
    spark: SparkSession, path: str, time_column: str, start=None, end=None
) -> DataFrame:
    """The dataset, optionally between two inclusive bounds.

    Both bounds or none. A date-only text end covers that whole day. An absent dataset raises.
    """
    if (start is None) != (end is None):
        raise ValueError("Give both bounds or none.")
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(month_predicate(start, end)).where(
            time_between(F.col(time_column), start, end)
        )
    return df
