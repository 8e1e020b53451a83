"""Running totals over a global (or per-group) order without a single-task window.

A window over a whole table, or over one hot group, would sort everything in one task.
Here the order is cut into slices at approximate quantiles of the order value. Each
(group, slice) is summed, the few slice sums are accumulated, and each slice runs its
own short window on top of the sum before it. No (group, slice) holds more than about
1/slices of all rows, whatever the group sizes are, because the cuts are quantiles over
all rows and callers collapse equal order values first. The cuts only balance the work;
the totals are exact for any cuts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.session import default_buckets

GROUP = "_group"
SLICE = "_slice"


def quantile_cuts(df: DataFrame, column: str, slices: int | None = None) -> list[float]:
    """Slice borders for an order column: one map-side pass, a bounded list comes back."""
    count = slices or default_buckets(df.sparkSession)
    if count < 2:
        return []
    wanted = [i / count for i in range(1, count)]
    values = df.select(F.col(column).cast("double").alias("v")).approxQuantile("v", wanted, 0.25 / count)
    return sorted({value for value in values if math.isfinite(value)})


def with_slice(df: DataFrame, column: str, cuts: Sequence[float]) -> DataFrame:
    """Add the slice number; binary search on the cuts, inside the JVM. Missing values sort first."""
    if not cuts:
        return df.withColumn(SLICE, F.lit(0))
    return (
        Bucketizer(
            splits=[-math.inf, *cuts, math.inf],
            inputCol="_order_value",
            outputCol=SLICE,
            handleInvalid="keep",
        )
        .transform(df.withColumn("_order_value", F.col(column).cast("double")))
        .drop("_order_value")
        # a missing order value has no slice of its own; a null would fall out of the join
        .withColumn(SLICE, F.coalesce(F.col(SLICE).cast("int"), F.lit(-1)))
    )


def slice_offsets(
    sliced: DataFrame, sums: Sequence[str], keyed: Sequence[str], descending: bool
) -> DataFrame:
    """Per (group, slice): the sum before it and the group's whole sum, for every listed column."""
    per_slice = sliced.groupBy(*keyed, SLICE).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    order = F.col(SLICE).desc() if descending else F.col(SLICE).asc()
    group = W.partitionBy(*keyed)
    before = group.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return per_slice.select(
        *keyed,
        SLICE,
        *[
            F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}")
            for c in sums
        ],
        *[F.sum(f"_sum_{c}").over(group).alias(f"total_{c}") for c in sums],
    )


def running_totals(
    rows: DataFrame,
    order_by: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] = (),
) -> DataFrame:
    """Add ``running_<c>`` (up to and including the row) and ``total_<c>`` for each column.

    ``rows`` holds one row per (keys, order value). Keys are carried as one struct, so that
    missing key values form a group of their own and the join keeps the window's partitioning.
    The slice sums and the windows share one shuffle of ``rows`` when the summed columns are
    built from all aggregated columns of ``rows``, so that none is pruned from only one side.
    """
    grouped = rows.withColumn(GROUP, F.struct(*keys)) if keys else rows
    keyed = [GROUP] if keys else []
    sliced = with_slice(grouped, order_by, cuts)
    offsets = slice_offsets(sliced, sums, keyed, descending)
    order = F.col(order_by).desc() if descending else F.col(order_by).asc()
    within = W.partitionBy(*keyed, SLICE).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = sliced.withColumns({f"_run_{c}": F.sum(c).over(within) for c in sums})
    joined = local.join(offsets, [*keyed, SLICE])
    return joined.select(
        *rows.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_run_{c}")).alias(f"running_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )
