"""Descriptive tables: profiles, shares, incidence, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.functions.scalars import numeric_columns, ratio, to_long
from cohorta.operators.joins import join_on_keys
from cohorta.operators.ranks import column_percentiles


def null_counts(df: DataFrame, label: str) -> DataFrame:
    """(column_name, <label>): missing values per column from one aggregate."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(label)) for c in df.columns]
    )
    return counted.select(F.inline(rows))


def null_profile(left: DataFrame, right: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Missing values per column of two tables side by side."""
    return join_on_keys(
        null_counts(left, labels[0]), null_counts(right, labels[1]), ["column_name"], "full_outer"
    )


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    chosen = numeric_columns(df, columns)
    long = to_long(df, chosen, [], "double").where(F.col("value").isNotNull())
    spread = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    found = column_percentiles(df, chosen, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    rows = [(name, q["p25"], q["p50"], q["p75"]) for name, q in found.items()]
    quartiles = df.sparkSession.createDataFrame(rows, "feature string, p25 double, p50 double, p75 double")
    return spread.join(quartiles, "feature")


def most_frequent() -> Column:
    """Aggregate over (value, n) counts: the value with the highest count, smallest on a tie."""
    return F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value")))["value"]


def string_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value (smallest on a tie) and its frequency per column."""
    counts = (
        to_long(df, columns, [], "string")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        most_frequent().alias("top"),
        F.max("n").alias("freq"),
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(left_column, right_column, correlation) over complete pairs; one aggregate, long form."""
    chosen = numeric_columns(df, columns)
    pairs = list(combinations(chosen, 2))
    wide = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    both_ways = [(a, b, F.col(f"c{i}")) for i, (a, b) in enumerate(pairs)]
    both_ways += [(b, a, value) for a, b, value in both_ways]
    both_ways += [(c, c, F.lit(1.0)) for c in chosen]
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("left_column"),
                F.lit(b).alias("right_column"),
                value.alias("correlation"),
            )
            for a, b, value in both_ways
        ]
    )
    return wide.select(F.inline(rows))


def category_shares(df: DataFrame, columns: Sequence[str], name: str = "share") -> DataFrame:
    """Share of rows per combination of categories; rows with a missing category do not count."""
    counts = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.select(*columns, ratio(F.col("_n"), total).alias(name))


def compare_shares(
    left: DataFrame, right: DataFrame, columns: Sequence[str], labels: Sequence[str]
) -> DataFrame:
    """Category shares of two tables side by side."""
    return join_on_keys(
        category_shares(left, columns, labels[0]),
        category_shares(right, columns, labels[1]),
        list(columns),
        "full_outer",
    )


def key_overlap(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """(column_name, matched_rows, equal_values) over the keys both tables share."""
    wanted = [key, *columns]
    a = left.select(*[F.col(c).alias(c if c == key else f"{c}_left") for c in wanted])
    b = right.select(*[F.col(c).alias(c if c == key else f"{c}_right") for c in wanted])
    counted = a.join(b, key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"{c}_left") == F.col(f"{c}_right")).alias(c) for c in columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("matched_rows"),
                F.col(c).alias("equal_values"),
            )
            for c in columns
        ]
    )
    return counted.select(F.inline(rows))


def incidence(df: DataFrame, by: Sequence[str | Column], target: str) -> DataFrame:
    """Row count and mean target per category."""
    return df.groupBy(*by).agg(
        F.count(target).alias("rows"), F.avg(F.col(target).cast("double")).alias("incidence")
    )


def mean_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean of a number per combination of categories."""
    return df.groupBy(*by).agg(F.avg(F.col(value).cast("double")).alias(f"mean_{value}"))


def fixed_bin(value: Column, low: float, high: float, width: float) -> Column:
    """Upper border of the right-closed bin; the lowest border is included; null outside."""
    step = F.greatest(F.ceil((value - low) / width), F.lit(1))
    return F.when(value.between(low, high), low + step * width)


def incidence_fixed_bins(
    df: DataFrame, value: str, target: str, low: float, high: float, width: float
) -> DataFrame:
    bins = fixed_bin(F.col(value), low, high, width).cast("double").alias("bin_high")
    return incidence(df, [bins], target).where(F.col("bin_high").isNotNull())


def incidence_quantiles(df: DataFrame, value: str, target: str, parts: int = 10) -> DataFrame:
    """Incidence by equal-mass bin; repeated borders merge, bins are right-closed."""
    named = {f"q{i}": i / parts for i in range(parts + 1)}
    found = column_percentiles(df, [value], named)[value]
    borders = sorted({border for border in found.values() if border is not None})
    number = F.col(value).cast("double")
    index = F.lit(1)
    for border in borders[1:-1]:
        index = index + F.when(number > border, 1).otherwise(0)
    rows = df.where(number.isNotNull())
    upper = F.element_at(F.array(*map(F.lit, borders[1:] or borders)), F.col("bin"))
    return incidence(rows, [index.cast("int").alias("bin")], target).withColumn("bin_high", upper)


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per equal-width bin (left-closed, last bin closed on both sides), split by columns."""
    number = F.col(value).cast("double")
    index = F.least(F.floor((number - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    return (
        df.where(number.between(low, high))
        .groupBy(*by, index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
