"""Isotonic maps from score to observed rate that stay tables, whatever their length.

Pooling adjacent violators gives one result in whatever order violators are pooled. So each slice of
the scores pools its own, and what is left are blocks of rising rates. Where the last block of a slice
is not below the first one of the next, pairs of neighbouring slices pool together, with other pairs
every round, until no border is violated. A slice never gets more blocks than it had.

A map is applied as an interval join: its line segments and the scores meet by slice of the scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.operators.prefix import SLICE, quantile_cuts, with_slice
from cohorta.session import materialize

SLICE_ROWS = 1_000_000  # distinct scores a slice is meant to have at most
SEGMENTS = 32  # segments of a map that a score is compared with
MOST_SLICES = 4096


def pool(hits: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """First position of each block that pooling adjacent violators leaves."""
    first: list[int] = []
    h: list[float] = []
    w: list[float] = []
    for i, (a, b) in enumerate(zip(hits.tolist(), weight.tolist(), strict=True)):
        first.append(i)
        h.append(a)
        w.append(b)
        while len(h) > 1 and h[-2] * w[-1] >= h[-1] * w[-2]:
            a, b = h.pop(), w.pop()
            h[-1] += a
            w[-1] += b
            first.pop()
    return np.array(first, np.int64)


def _pool_rows(rows: pa.Table) -> pa.Table:
    """Blocks of one group's rows; a block has the keys and the slice of its first row."""
    rows = rows.take(pa.array(np.argsort(rows["low"].to_numpy(), kind="stable")))
    hits, weight = rows["hits"].to_numpy(), rows["weight"].to_numpy()
    first = pool(hits, weight)
    last = np.append(first[1:], len(hits)) - 1
    blocks = rows.take(pa.array(first))
    for name, values in (
        ("high", rows["high"].to_numpy()[last]),
        ("hits", np.add.reduceat(hits, first)),
        ("weight", np.add.reduceat(weight, first)),
    ):
        blocks = blocks.set_column(blocks.column_names.index(name), name, pa.array(values))
    return blocks


def _edges(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a slice that has blocks: its place, whether its lower border is violated, and its neighbour's first block."""
    rate = F.col("hits") / F.col("weight")
    ends = blocks.groupBy(*keys, SLICE).agg(
        F.min_by(rate, "low").alias("first"), F.max_by(rate, "low").alias("last"), F.min("low").alias("start")
    )
    order = W.partitionBy(*keys).orderBy(SLICE)
    return ends.select(
        *keys,
        SLICE,
        (F.row_number().over(order) - 1).alias("place"),
        F.coalesce(F.lag("last").over(order) >= F.col("first"), F.lit(False)).alias("violated"),
        F.lead("start").over(order).alias("next_low"),
        F.lead("first").over(order).alias("next_rate"),
    )


def _on(left: DataFrame, right: DataFrame, names: Sequence[str]):
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def isotonic_blocks(counts: DataFrame, keys: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """(keys, slice, low, high, hits, weight): scores from low to high share the rate hits / weight.

    ``counts`` holds (keys, score, pos, neg). Scores that are null or NaN, and those without rows, take no part.
    """
    keys = list(keys)
    weight = (F.col("pos") + F.col("neg")).cast("double")
    cells = (
        counts.where(F.col("score").isNotNull() & ~F.isnan("score"))
        .groupBy(*keys, "score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where("pos + neg > 0")
        .select(*keys, F.col("score").alias("low"), F.col("score").alias("high"), F.col("pos").cast("double").alias("hits"), weight.alias("weight"))
    )
    cells = materialize(cells, "isotonic-cells")
    if cuts is None:
        # a border between slices can cost a round of jobs, so few scores are not cut up
        slices = 1 + cells.count() // SLICE_ROWS
        cuts = quantile_cuts(cells, "low", slices)
    sliced = with_slice(cells, "low", cuts)
    schema = sliced.schema
    blocks = materialize(sliced.groupBy(*keys, SLICE).applyInArrow(_pool_rows, schema), "isotonic-blocks")
    turn = 0
    while True:
        edges = materialize(_edges(blocks, keys), "isotonic-edges")
        if edges.where("violated").isEmpty():
            return blocks
        pairs = edges.select(*keys, SLICE, F.floor((F.col("place") + turn % 2) / 2).alias("_pair"))
        both = blocks.join(pairs, _on(blocks, pairs, [*keys, SLICE])).select(blocks["*"], "_pair")
        merged = both.groupBy(*keys, "_pair").applyInArrow(_pool_rows, both.schema)
        blocks = materialize(merged.drop("_pair"), "isotonic-blocks")
        turn += 1


def segments(blocks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x0, x1, y0, y1): the map as lines from x0 up to x1; flat inside blocks and beyond the outer ones."""
    keys = list(keys)
    edges = _edges(blocks, keys)
    rows = blocks.join(edges, _on(blocks, edges, [*keys, SLICE])).select(
        blocks["*"], "place", edges["next_low"], edges["next_rate"], (F.col("hits") / F.col("weight")).alias("rate")
    )
    order = W.partitionBy(*keys, SLICE).orderBy("low")
    rows = rows.withColumns(
        {
            "next_low": F.coalesce(F.lead("low").over(order), F.col("next_low")),
            "next_rate": F.coalesce(F.lead("rate").over(order), F.col("next_rate")),
            "outer": (F.col("place") == 0) & (F.row_number().over(order) == 1),
        }
    )
    rate, infinity = F.col("rate"), F.lit(float("inf"))

    def line(x0, x1, y1=rate):
        return F.struct(x0.alias("x0"), x1.alias("x1"), rate.alias("y0"), y1.alias("y1"))

    lines = F.array(
        F.when(F.col("outer"), line(-infinity, F.col("low"))),
        F.when(F.col("high") > F.col("low"), line(F.col("low"), F.col("high"))),
        line(F.col("high"), F.coalesce("next_low", infinity), F.coalesce("next_rate", rate)),
    )
    return rows.select(*keys, F.inline(F.filter(lines, lambda x: x.isNotNull())))


@dataclass
class IsotonicMap:
    """A fitted map, one for each value of the keys; its lines are a written table."""

    lines: DataFrame
    keys: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        finite = self.lines.where(F.col("x0") > F.lit(float("-inf")))
        self.cuts = quantile_cuts(finite, "x0", min(MOST_SLICES, finite.count() // SEGMENTS))

    def transform(self, df: DataFrame, output: str = "calibrated", score: str = "score") -> DataFrame:
        """The rows with the score's rate; null where the score is missing or its key has no map."""
        placed = with_slice(with_slice(self.lines, "x0", self.cuts).withColumnRenamed(SLICE, "_from"), "x1", self.cuts)
        spread = placed.withColumn("_at", F.explode(F.sequence("_from", SLICE))).select(
            *[F.col(k).alias(f"_key_{k}") for k in self.keys], "_at", "x0", "x1", "y0", "y1"
        )
        rows = with_slice(df.withColumn("_score", F.col(score).cast("double")), "_score", self.cuts)
        inside = (F.col(SLICE) == F.col("_at")) & (F.col("_score") >= F.col("x0")) & (F.col("_score") < F.col("x1"))
        for key in self.keys:
            inside = inside & (rows[key] == spread[f"_key_{key}"])
        part = (F.col("_score") - F.col("x0")) / (F.col("x1") - F.col("x0"))
        value = F.when(F.col("y0") == F.col("y1"), F.col("y0")).otherwise(F.col("y0") + (F.col("y1") - F.col("y0")) * part)
        return rows.join(spread, inside, "left").select(*[rows[c] for c in df.columns if c != output], value.alias(output))

    def save(self, path: str) -> None:
        self.lines.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> IsotonicMap:
        lines = spark.read.parquet(path)
        return cls(lines, [c for c in lines.columns if c not in ("x0", "x1", "y0", "y1")])


def fit_isotonic_map(counts: DataFrame, keys: Sequence[str] = (), cuts: Sequence[float] | None = None) -> IsotonicMap:
    """Map of (keys, score, pos, neg) rows, linear between its blocks; no rows give no map."""
    return IsotonicMap(materialize(segments(isotonic_blocks(counts, keys, cuts), keys), "isotonic-map"), list(keys))
