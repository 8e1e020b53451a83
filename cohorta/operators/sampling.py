"""Reproducible samples, splits and balanced assignments, independent of partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.operators.ranks import global_row_number, hash_order

# Fixed value: default seed of the balanced assignment.
DEFAULT_SEED = 42


def seeded_sample(df: DataFrame, key: str, size: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly ``size`` rows (or all, if fewer), the same for any partitioning."""
    return df.orderBy(hash_order(seed, key), key).limit(size)


def stratified_split(
    df: DataFrame, key: str, stratum: str, test_share: float = 0.3, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Add ``split``: in every stratum the first ceil(share * n) rows of the hash order are test."""
    ranked = global_row_number(
        df.withColumn("_hash", hash_order(seed, key)), "_hash", key, [stratum]
    )
    test_rows = F.ceil(F.col("group_rows") * F.lit(test_share))
    side = F.when(F.col("position") < test_rows, "test").otherwise("train")
    return ranked.select(*df.columns, side.alias("split"))


def assign_balanced(
    df: DataFrame, values: Sequence, column: str, key: str, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Add ``column`` with the given values in random groups whose sizes differ by at most one.

    ``key`` identifies a row. With N rows and m values the first N mod m groups get one more row.
    """
    if not values:
        raise ValueError("At least one value is needed.")
    ranked = global_row_number(df.withColumn("_hash", hash_order(seed, key)), "_hash", key)
    count = F.lit(len(values))
    size = F.floor(F.col("group_rows") / count)
    larger = F.col("group_rows") % count
    in_larger = larger * (size + 1)
    position = F.col("position")
    index = F.when(position < in_larger, F.floor(position / (size + 1))).otherwise(
        larger + F.floor((position - in_larger) / F.greatest(size, F.lit(1)))
    )
    chosen = F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
    return ranked.select(*df.columns, chosen.alias(column))


def _spine(bounds: DataFrame, step: str) -> DataFrame:
    """Explode one (low, high) row of dates into period starts."""
    low, high = F.col("low"), F.col("high")
    first = low
    if step.endswith("month"):
        floor = F.trunc(low, "month")
        first = F.when(floor == low, low).otherwise(F.add_months(floor, 1))
    dates = F.sequence(first, high, F.expr(f"interval {step}"))
    days = F.when(first <= high, dates).otherwise(F.array().cast("array<date>"))
    return bounds.select(F.explode(days).alias("day")).select(
        F.col("day").cast("timestamp_ntz").alias("period_start")
    )


def date_spine(spark: SparkSession, start: str, end: str, step: str = "1 month") -> DataFrame:
    """One row per period start in [start, end] as ``period_start``; months start on day one."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("low"), F.lit(str(end)).cast("date").alias("high")
    )
    return _spine(bounds, step)


def period_spine(df: DataFrame, time_column: str, step: str = "1 month") -> DataFrame:
    """Every period start between a table's first and last moment (one aggregated row)."""
    bounds = df.agg(
        F.to_date(F.min(time_column)).alias("low"), F.to_date(F.max(time_column)).alias("high")
    )
    return _spine(bounds, step)
