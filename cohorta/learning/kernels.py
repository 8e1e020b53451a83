"""Radial kernel as random Fourier features: inner products of the features approximate the kernel.

The kernel is exp(-gamma |a - b|^2) with gamma = 1 / (width x variance of all cells). A feature is a cosine of a
random direction and phase; the mean error of an inner product is of order 1 / sqrt(components). The
directions follow from the seed, so a fitted stage is three numbers. Rows are mapped by matrix
products of `ROWS` rows each, written where the answer of their Arrow batch lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.learning.stages import Saved, _Fitted

COMPONENTS = 512
ROWS = 256
OUTPUT = "fourier"


def directions(state: dict) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(state["seed"])
    spread = np.sqrt(2 * state["gamma"])
    return rng.normal(size=(state["width"], state["components"])) * spread, rng.uniform(0, 2 * np.pi, state["components"])


def fourier(state: dict, values: pa.Array) -> pa.Array:
    """Features of rows given as lists; memory beyond the answer is that of a few rows."""
    along, phase = directions(state)
    rows = values.flatten().to_numpy().reshape(len(values), state["width"])
    out = np.empty((len(rows), state["components"]))
    for low in range(0, len(rows), ROWS):
        part = out[low : low + ROWS]
        np.matmul(rows[low : low + ROWS], along, out=part)
        part += phase
        np.cos(part, out=part)
        part *= np.sqrt(2 / state["components"])
    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * state["components"])
    return pa.ListArray.from_arrays(ends, pa.array(out.reshape(-1)))


class FourierModel(_Fitted):
    """Adds the ``fourier`` vector."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.fitted()

        @F.arrow_udf("array<double>")
        def features(values: pa.Array) -> pa.Array:
            return fourier(state, values)

        return dataset.withColumn(OUTPUT, array_to_vector(features(vector_to_array("features"))))


class FourierFeatures(Estimator, Saved):
    """Fits the kernel's width from one aggregate of the feature moments."""

    settings = Param(Params._dummy(), "settings", "seed and components", TypeConverters.identity)

    def __init__(self, seed: int = 0, components: int = COMPONENTS):
        super().__init__()
        self._set(settings={"seed": seed, "components": components})

    def _fit(self, dataset: DataFrame) -> FourierModel:
        summary = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
        row = dataset.agg(summary.alias("s")).select("s.count", "s.mean", "s.variance").first()
        mean, n = row["mean"].toArray(), row["count"]
        within = row["variance"].toArray() * (n - 1) / n
        variance = float(within.mean() + mean.var())  # of all cells together
        width = len(mean)
        return FourierModel({**self.getOrDefault(self.settings), "width": width, "gamma": 1 / (width * variance) if variance > 0 else 1.0})
