"""Small column expressions shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DATE_ONLY = re.compile(r"\d{4}-\d{2}-\d{2}")


def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename every column to its trimmed, lower-case, underscored form."""
    names = [normalize_name(name) for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"Column names collide after normalising: {repeated}.")
    return df.toDF(*names)


def require_columns(df: DataFrame, needed: Sequence[str], label: str) -> None:
    absent = sorted(set(needed) - set(df.columns))
    if absent:
        raise ValueError(f"{label}: absent columns {', '.join(absent)}.")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double; null where the bottom is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def is_finite(value: Column) -> Column:
    number = value.cast("double")
    return ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def period_start(time: Column, period: str = "month") -> Column:
    """First instant of the period a naive timestamp falls in."""
    return F.date_trunc(period, time.cast("timestamp_ntz")).cast("timestamp_ntz")


def utc_naive(value: Column) -> Column:
    """ISO text as a naive UTC timestamp; text without an offset is UTC already, other text is null."""
    moment = value.try_cast("timestamp").cast("timestamp_ntz")
    in_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment)
    has_offset = value.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(has_offset, in_utc).otherwise(value.try_cast("timestamp_ntz"))


def month_number(year: Column, month: Column) -> Column:
    return year * 100 + month


def is_date_only(bound) -> bool:
    return isinstance(bound, str) and bool(_DATE_ONLY.fullmatch(bound.strip()))


def time_between(time: Column, start, end) -> Column:
    """start <= time <= end; a date-only text end covers that whole day."""
    moment = time.cast("timestamp_ntz")
    low = F.lit(str(start)).cast("timestamp_ntz")
    high = F.lit(str(end)).cast("timestamp_ntz")
    if is_date_only(end):
        return (moment >= low) & (moment < high + F.expr("interval 1 day"))
    return (moment >= low) & (moment <= high)


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    chosen = df.columns if among is None else among
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [name for name in chosen if isinstance(kinds[name], T.NumericType)]


def string_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    chosen = df.columns if among is None else among
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [name for name in chosen if isinstance(kinds[name], T.StringType)]


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str], dtype: str) -> DataFrame:
    """(keep..., feature, value): one row per listed column, read in one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(name).cast(dtype).alias("value"))
            for name in columns
        ]
    )
    return df.select(*keep, F.inline(pairs))
