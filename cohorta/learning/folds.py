"""Expanding-window folds over distinct timestamps."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.functions.scalars import require_columns
from cohorta.operators.prefix import quantile_cuts, running_totals


@dataclass(frozen=True)
class Fold:
    """Rows before ``start`` train; rows from ``start`` up to and including ``end`` validate."""

    number: int
    start: dt.datetime
    end: dt.datetime

    def in_train(self, time):
        return time < F.lit(self.start.isoformat()).cast("timestamp_ntz")

    def in_validation(self, time):
        low, high = (F.lit(b.isoformat()).cast("timestamp_ntz") for b in (self.start, self.end))
        return (time >= low) & (time <= high)

    def split(self, df: DataFrame, time_column: str) -> tuple[DataFrame, DataFrame]:
        time = F.col(time_column).cast("timestamp_ntz")
        return df.where(self.in_train(time)), df.where(self.in_validation(time))


def temporal_folds(df: DataFrame, target: str, time_column: str, n_splits: int) -> list[Fold]:
    """Folds whose history lies strictly before their validation rows.

    The distinct timestamps, oldest first, are cut into validation blocks of T // (n + 1); only
    the block borders come to the driver. Equal timestamps stay together, and every side must
    hold both classes.
    """
    require_columns(df, [target, time_column], "temporal folds")
    if target == time_column:
        raise ValueError("Target and time must be different columns.")
    if not isinstance(n_splits, int) or n_splits < 2:
        raise ValueError("At least two folds are needed.")
    time = F.col(time_column).try_cast("timestamp_ntz")
    moments = df.select(time.alias("time")).withColumn(
        "moment", F.unix_micros(F.col("time").cast("timestamp"))
    )
    if not moments.where(F.col("time").isNull()).limit(1).isEmpty():
        raise ValueError("Every row needs a valid timestamp.")
    distinct = moments.groupBy("moment").agg(F.min("time").alias("time"), F.lit(1).alias("n"))
    placed = running_totals(distinct, "moment", ["n"], cuts=quantile_cuts(moments, "moment"))
    rank, total = F.col("running_n") - 1, F.col("total_n")
    size = F.floor(total / (n_splits + 1))

    def at(position):
        return F.max(F.when(rank == position, F.col("time")))

    borders = []
    for k in range(n_splits):
        start = total - (n_splits - k) * size
        borders += [at(start).alias(f"start_{k}"), at(start + size - 1).alias(f"end_{k}")]
    found = placed.agg(F.max("total_n").alias("times"), *borders).first()
    if (found["times"] or 0) <= n_splits:
        raise ValueError(f"{found['times']} distinct timestamps cannot form {n_splits} folds.")
    folds = [Fold(k + 1, found[f"start_{k}"], found[f"end_{k}"]) for k in range(n_splits)]
    _check_classes(df, target, time_column, folds)
    return folds


def _check_classes(df: DataFrame, target: str, time_column: str, folds: list[Fold]) -> None:
    time, label = F.col(time_column).cast("timestamp_ntz"), F.col(target)
    checks = []
    for fold in folds:
        for side, inside in (("train", fold.in_train(time)), ("valid", fold.in_validation(time))):
            chosen = F.when(inside, label)
            checks.append(F.coalesce(F.min(chosen) == F.max(chosen), F.lit(True)).alias(f"{side}_{fold.number}"))
    single = [name for name, one in df.agg(*checks).first().asDict().items() if one]
    if single:
        raise ValueError(f"Folds without both classes: {', '.join(single)}.")


def fold_table(df: DataFrame, time_column: str, folds: list[Fold]) -> DataFrame:
    """Rows repeated per (fold, role) they take part in: at most once per fold."""
    time = F.col(time_column).cast("timestamp_ntz")
    parts = []
    for fold in folds:
        role = F.when(fold.in_train(time), "train").when(fold.in_validation(time), "validation")
        parts.append(F.struct(F.lit(fold.number).alias("fold"), role.alias("role")))
    return df.select("*", F.inline(F.array(*parts))).where(F.col("role").isNotNull())
