"""Joins on report keys, where a missing key value matches a missing key value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join with null-safe keys; a full outer join returns the merged keys.

    No broadcast hint: the planner compares the measured size with its own limit.
    """
    renamed = right.select(
        *[F.col(key).alias(f"_right_{key}") for key in keys],
        *[name for name in right.columns if name not in keys],
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    )
    joined = left.join(renamed, condition, how)
    if how in {"left_semi", "left_anti"}:
        return joined
    merged = [
        (F.coalesce(F.col(key), F.col(f"_right_{key}")) if how == "full_outer" else F.col(key)).alias(key)
        for key in keys
    ]
    left_rest = [name for name in left.columns if name not in keys]
    right_rest = [name for name in right.columns if name not in keys]
    return joined.select(*merged, *left_rest, *right_rest)


def full_outer_all(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of any number of tables on the same keys."""
    return reduce(lambda a, b: join_on_keys(a, b, keys, "full_outer"), tables)
