"""Exact percentiles and exact global row numbers, both spread over all tasks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.operators.prefix import quantile_cuts, running_totals
from cohorta.session import default_buckets, materialize


def value_positions(
    df: DataFrame, value: str, keys: Sequence[str] = (), cuts: Sequence[float] | None = None
) -> DataFrame:
    """One row per (keys, value) with its count ``n`` and the positions it covers.

    Positions are zero-based: ``first <= position < last``. Rows whose value is missing keep a
    count in ``rows`` but cover no position.
    """
    if cuts is None:
        cuts = quantile_cuts(df, value)
    counted = (
        df.groupBy(*keys, F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("n", F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(F.lit(0)))
    )
    placed = running_totals(counted, "value", ["n"], keys, cuts=cuts)
    return placed.withColumns(
        {"first": F.col("running_n") - F.col("n"), "last": F.col("running_n")}
    )


def _value_at(position: Column) -> Column:
    inside = (F.col("first") <= position) & (position < F.col("last"))
    return F.max(F.when(inside, F.col("value")))


def percentile_columns(named: Mapping[str, float], among: Column | None = None) -> list[Column]:
    """Aggregates over ``value_positions``: linearly interpolated percentiles by name."""
    out = []
    for name, share in named.items():
        exact = (F.col("total_n") - 1) * F.lit(float(share))
        low, high = F.floor(exact), F.ceil(exact)
        if among is not None:
            low, high = F.when(among, low), F.when(among, high)
        bottom, top = _value_at(low), _value_at(high)
        weight = F.max(exact - F.floor(exact) if among is None else F.when(among, exact - F.floor(exact)))
        out.append((bottom + (top - bottom) * weight).alias(name))
    return out


def grouped_percentiles(
    df: DataFrame, value: str, named: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated percentiles per group; no group is held in one task."""
    return value_positions(df, value, keys).groupBy(*keys).agg(*percentile_columns(named))


RANK_ERROR = 0.001


def column_percentiles(
    df: DataFrame, columns: Sequence[str], named: Mapping[str, float]
) -> dict[str, dict[str, float | None]]:
    """Exact interpolated percentiles of whole columns, without shuffling the columns.

    A sketch with a known rank error brackets every wanted percentile. One map-side pass counts
    the values below each bracket, another keeps only the values inside it, a few thousandths of
    the rows, collapsed by value. The exact value is picked from those. One number per column
    and percentile comes back; missing values and NaN do not count.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    valid = {c: values[c].isNotNull() & ~F.isnan(values[c]) for c in columns}
    result: dict[str, dict[str, float | None]] = {c: dict.fromkeys(named) for c in columns}
    totals = df.agg(*[F.count_if(valid[c]).alias(c) for c in columns]).first().asDict()
    filled = [c for c in columns if totals[c]]
    if not filled or not named:
        return result
    margin = 2 * RANK_ERROR + 2 / min(totals[c] for c in filled)
    edges = [min(max(p + d, 0.0), 1.0) for p in named.values() for d in (-margin, margin)]
    numbers = df.select(*[values[c].alias(c) for c in filled])
    sketched = numbers.approxQuantile(filled, edges, RANK_ERROR)
    cells, counts = [], []
    for c, found in zip(filled, sketched):
        for i, name in enumerate(named):
            low, high = F.lit(found[2 * i]), F.lit(found[2 * i + 1])
            inside = valid[c] & (values[c] >= low) & (values[c] <= high)
            key = f"{len(cells)}"
            cells.append(
                F.when(inside, F.struct(F.lit(c).alias("feature"), F.lit(name).alias("name"), values[c].alias("value")))
            )
            counts.append((key, c, name, F.count_if(valid[c] & (values[c] < low)).alias(key)))
    # an aggregate, not observed metrics: a repeated task must not count twice
    below = df.agg(*[column for *_, column in counts]).first()
    kept = (
        df.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("feature", "name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kept = materialize(kept, "brackets")
    placed = running_totals(kept, "value", ["n"], ["feature", "name"], cuts=quantile_cuts(kept, "value"))
    placed = placed.withColumns({"first": F.col("running_n") - F.col("n"), "last": F.col("running_n")})
    picks = []
    for key, c, name, _ in counts:
        exact = (totals[c] - 1) * named[name]
        here = (F.col("feature") == c) & (F.col("name") == name)
        for side, position in (("low", math.floor(exact)), ("high", math.ceil(exact))):
            at = F.lit(position - below[key])
            inside = here & (F.col("first") <= at) & (at < F.col("last"))
            picks.append(F.max(F.when(inside, F.col("value"))).alias(f"{side}_{key}"))
    row = placed.agg(*picks).first()
    for key, c, name, _ in counts:
        low, high = row[f"low_{key}"], row[f"high_{key}"]
        if low is None or high is None:
            raise RuntimeError(f"The sketch did not bracket the {name} of {c!r}.")
        exact = (totals[c] - 1) * named[name]
        result[c][name] = low + (high - low) * (exact - math.floor(exact))
    return result


def hash_order(seed, key: str | Column) -> Column:
    """Reproducible pseudo-random order of rows: md5 over the seed and a unique row key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), column.cast("string")))


def global_row_number(
    df: DataFrame, order_hash: str, unique_key: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``position`` (zero-based) and ``group_rows`` in the order of an md5 column.

    Hash prefixes are uniform, so equal ranges of the prefix are equal slices of the rows.
    """
    slices = min(default_buckets(df.sparkSession), 65536)
    prefix = F.conv(F.substring(order_hash, 1, 4), 16, 10).cast("int")
    sliced = df.withColumn("_part", F.floor(prefix * F.lit(slices) / F.lit(65536)).cast("int"))
    if keys:
        sliced = sliced.withColumn("_group", F.struct(*keys))
    keyed = ["_group"] if keys else []
    sizes = sliced.groupBy(*keyed, "_part").agg(F.count(F.lit(1)).alias("_n"))
    group = W.partitionBy(*keyed)
    before = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *keyed,
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("group_rows"),
    )
    within = W.partitionBy(*keyed, "_part").orderBy(order_hash, unique_key)
    return (
        sliced.withColumn("_row", F.row_number().over(within))
        .join(offsets, [*keyed, "_part"])
        .select(*df.columns, (F.col("_before") + F.col("_row") - 1).alias("position"), "group_rows")
    )
