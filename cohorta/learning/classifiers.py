"""Classifiers Spark ML does not have, fitted from one-pass aggregates.

All follow the Spark ML column conventions (features, rawPrediction, probability,
prediction). Class statistics and matrices are as wide as the features; rows stay put.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.learning.stages import Saved, _Fitted
from cohorta.session import materialize


def numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def sigmoid(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))


class MarginModel(_Fitted):
    """Turns a margin expression (log-odds of class 1) into the standard output columns."""

    def margin(self, x: Column) -> Column:
        raise NotImplementedError

    def positive(self, margin: Column) -> Column:
        return sigmoid(margin)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = dataset.withColumn("_margin", self.margin(vector_to_array(F.col("features"))))
        rows = rows.withColumn("_p", self.positive(F.col("_margin")))
        return rows.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                "probability": array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))),
                "prediction": (F.col("_p") >= 0.5).cast("double"),
            }
        ).drop("_margin", "_p")


class BinaryEstimator(Estimator, HasFeaturesCol, HasLabelCol, Saved):
    """Common settings: where features and labels are."""

    settings = Param(Params._dummy(), "settings", "hyper-parameters", TypeConverters.identity)

    def __init__(self, labelCol="label", **settings):
        super().__init__()
        self._set(labelCol=labelCol, featuresCol="features", settings=settings)

    def setting(self, name: str, default):
        return self.getOrDefault(self.settings).get(name, default)

    def class_moments(self, dataset: DataFrame) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Per class 0 and 1: row count, mean and population variance of the features."""
        summary = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
        found = (
            dataset.groupBy(F.col(self.getLabelCol()).cast("int").alias("y"))
            .agg(summary.alias("s"))
            .select("y", "s.count", "s.mean", "s.variance")
            .collect()
        )
        by_class = {row["y"]: row for row in found}
        if set(by_class) != {0, 1}:
            raise ValueError("Training rows must hold both classes.")
        return [
            (
                float(by_class[y]["count"]),
                np.array(by_class[y]["mean"].toArray()),
                np.array(by_class[y]["variance"].toArray()) * (by_class[y]["count"] - 1) / by_class[y]["count"],
            )
            for y in (0, 1)
        ]

    def class_covariances(
        self, dataset: DataFrame, means: list[np.ndarray], counts: list[float]
    ) -> list[np.ndarray]:
        """Per class: population covariance of the features.

        Every Arrow batch becomes one centred cross-product per class; Spark adds them up cell
        by cell, so the driver sees width x width numbers however many batches there are.
        """
        width = len(means[0])

        def cross_products(batches):
            sums = [np.zeros((width, width)), np.zeros((width, width))]
            for batch in batches:
                labels = batch["y"].to_numpy()
                x = np.stack(batch["x"].to_list()) if len(batch) else np.zeros((0, width))
                for y in (0, 1):
                    centred = x[labels == y] - means[y]
                    sums[y] += centred.T @ centred
            yield pd.DataFrame({"y": [0, 1], "cells": [s.ravel().tolist() for s in sums]})

        rows = dataset.select(
            F.col(self.getLabelCol()).cast("int").alias("y"), vector_to_array("features").alias("x")
        )
        partial = rows.mapInPandas(cross_products, "y int, cells array<double>")
        cells = partial.select("y", F.posexplode("cells").alias("cell", "value"))
        matrices = [np.zeros(width * width), np.zeros(width * width)]
        for row in cells.groupBy("y", "cell").agg(F.sum("value").alias("value")).collect():
            matrices[row["y"]][row["cell"]] = row["value"]
        return [m.reshape(width, width) / n for m, n in zip(matrices, counts)]


class MajorityModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = float(self.fitted()["label"])
        vector = array_to_vector(numbers([1 - p, p]))
        return dataset.withColumns(
            {"rawPrediction": vector, "probability": vector, "prediction": F.lit(p)}
        )


class MajorityClassifier(BinaryEstimator):
    """Always the more frequent class (class 0 on a tie)."""

    def _fit(self, dataset: DataFrame) -> MajorityModel:
        label = F.col(self.getLabelCol())
        row = dataset.agg(F.count_if(label == 1).alias("p"), F.count_if(label == 0).alias("n")).first()
        return MajorityModel({"label": int(row["p"] > row["n"])})


class GaussianBayesModel(MarginModel):
    """Log-odds of two axis-aligned Gaussians: constant + linear + quadratic part."""

    def margin(self, x: Column) -> Column:
        state = self.fitted()
        squares = F.transform(x, lambda v: v * v)
        return F.lit(state["constant"]) + dot(numbers(state["linear"]), x) + dot(numbers(state["square"]), squares)


class GaussianBayes(BinaryEstimator):
    """Gaussian naive Bayes; variances grow by ``var_smoothing`` times the largest one."""

    def _fit(self, dataset: DataFrame) -> GaussianBayesModel:
        (n0, m0, v0), (n1, m1, v1) = self.class_moments(dataset)
        w0, w1 = n0 / (n0 + n1), n1 / (n0 + n1)
        whole = w0 * (v0 + m0**2) + w1 * (v1 + m1**2) - (w0 * m0 + w1 * m1) ** 2
        floor = self.setting("var_smoothing", 1e-9) * max(float(whole.max()), 0.0) or 1e-300
        v0, v1 = v0 + floor, v1 + floor
        constant = math.log(w1 / w0) + 0.5 * float(
            np.sum(np.log(v0) - np.log(v1) + m0**2 / v0 - m1**2 / v1)
        )
        return GaussianBayesModel(
            {
                "constant": constant,
                "linear": (m1 / v1 - m0 / v0).tolist(),
                "square": (0.5 / v0 - 0.5 / v1).tolist(),
            }
        )


class LinearMarginModel(MarginModel):
    def margin(self, x: Column) -> Column:
        return F.lit(self.fitted()["constant"]) + dot(numbers(self.fitted()["linear"]), x)


class LinearDiscriminant(BinaryEstimator):
    """Two Gaussians with a shared covariance; directions without variance are left out."""

    def _fit(self, dataset: DataFrame) -> LinearMarginModel:
        (n0, m0, _), (n1, m1, _) = self.class_moments(dataset)
        c0, c1 = self.class_covariances(dataset, [m0, m1], [n0, n1])
        pooled = (n0 * c0 + n1 * c1) / (n0 + n1)
        deviation = np.sqrt(np.diag(pooled))
        deviation[deviation == 0] = 1.0
        scaled = pooled / np.outer(deviation, deviation)
        inverse = np.linalg.pinv(scaled, rcond=self.setting("tol", 1e-4) ** 2, hermitian=True)
        linear = (inverse @ ((m1 - m0) / deviation)) / deviation
        constant = math.log(n1 / n0) - 0.5 * float(linear @ (m0 + m1))
        return LinearMarginModel({"constant": constant, "linear": linear.tolist()})


class QuadraticModel(MarginModel):
    """Difference of two Gaussian log densities in their principal axes."""

    def margin(self, x: Column) -> Column:
        def log_density(part: dict) -> Column:
            centred = F.zip_with(x, numbers(part["mean"]), lambda a, b: a - b)
            axes = F.array(*[numbers(axis) for axis in part["axes"]])
            along = F.transform(axes, lambda axis: dot(axis, centred))
            squares = F.transform(along, lambda v: v * v)
            return F.lit(part["constant"]) - F.lit(0.5) * dot(numbers(part["weights"]), squares)

        zero, one = self.fitted()["classes"]
        return log_density(one) - log_density(zero)


class QuadraticDiscriminant(BinaryEstimator):
    """One Gaussian per class; variances shrink towards one by ``reg_param``."""

    def _fit(self, dataset: DataFrame) -> QuadraticModel:
        moments = self.class_moments(dataset)
        covariances = self.class_covariances(
            dataset, [mean for _, mean, _ in moments], [n for n, _, _ in moments]
        )
        total = sum(n for n, _, _ in moments)
        shrink = self.setting("reg_param", 0.0)
        classes = []
        for (n, mean, _), covariance in zip(moments, covariances):
            strength, axes = np.linalg.eigh(covariance * n / (n - 1))
            strength = (1 - shrink) * np.maximum(strength, 0) + shrink
            kept = strength > 1e-12
            classes.append(
                {
                    "mean": mean.tolist(),
                    "axes": axes.T[kept].tolist(),
                    "weights": (1 / strength[kept]).tolist(),
                    "constant": math.log(n / total) - 0.5 * float(np.log(strength[kept]).sum()),
                }
            )
        return QuadraticModel({"classes": classes})


class BoostedStumpsModel(MarginModel):
    """Weighted vote of decision stumps; the margin is twice the mean signed vote."""

    def margin(self, x: Column) -> Column:
        stumps = self.fitted()["stumps"]
        total = sum(abs(s["weight"]) for s in stumps) or 1.0
        votes = F.array(
            *[
                F.struct(
                    F.lit(s["feature"]).alias("feature"),
                    F.lit(s["cut"]).alias("cut"),
                    F.lit(s["weight"] * (2 * s["low"] - 1)).alias("low"),
                    F.lit(s["weight"] * (2 * s["high"] - 1)).alias("high"),
                )
                for s in stumps
            ]
        )
        signed = F.aggregate(
            votes,
            F.lit(0.0),
            lambda sum_, s: sum_ + F.when(F.get(x, s["feature"]) <= s["cut"], s["low"]).otherwise(s["high"]),
        )
        return 2 * signed / total


def _stump_prediction(x: Column, stump: dict) -> Column:
    return F.when(x[stump["feature"]] <= stump["cut"], stump["low"]).otherwise(stump["high"])


class BoostedStumps(BinaryEstimator):
    """Adaptive boosting of depth-one trees with a weight column.

    Row weights are carried as a column; every ``write_every`` rounds the rows are written to
    the shared folder, so the plan stays short and survives lost executors.
    """

    def _fit(self, dataset: DataFrame) -> BoostedStumpsModel:
        rate, rounds = self.setting("learning_rate", 1.0), self.setting("n_estimators", 100)
        every = self.setting("write_every", 10)
        rows = materialize(
            dataset.select(
                F.col("features").alias("features", metadata={}),
                F.col(self.getLabelCol()).cast("double").alias("y"),
                F.lit(1.0).alias("w"),
            ),
            "boosting",
        )
        learner = DecisionTreeClassifier(
            maxDepth=1, featuresCol="features", labelCol="y", weightCol="w",
            seed=self.setting("random_state", 0),
        )
        stumps: list[dict] = []
        for number in range(1, rounds + 1):
            root = learner.fit(rows)._java_obj.rootNode()
            if not hasattr(root, "split") or root.subtreeDepth() == 0:
                break
            stump = {
                "feature": int(root.split().featureIndex()),
                "cut": float(root.split().threshold()),
                "low": int(root.leftChild().prediction()),
                "high": int(root.rightChild().prediction()),
            }
            wrong = _stump_prediction(vector_to_array("features"), stump) != F.col("y")
            sums = rows.agg(
                F.sum(F.when(wrong, F.col("w")).otherwise(0.0)).alias("wrong"), F.sum("w").alias("all")
            ).first()
            error = sums["wrong"] / sums["all"]
            if error <= 0:
                stumps.append(stump | {"weight": 1.0})
                break
            if error >= 0.5:
                if not stumps:
                    stumps.append(stump | {"weight": 1.0})
                break
            weight = rate * math.log((1 - error) / error)
            stumps.append(stump | {"weight": weight})
            grown = F.col("w") * F.when(wrong, math.exp(weight)).otherwise(1.0) / F.lit(sums["all"])
            rows = rows.withColumn("w", grown)
            if number % every == 0:
                rows = materialize(rows, "boosting")
        if not stumps:
            raise ValueError("No stump separates the classes.")
        return BoostedStumpsModel({"stumps": stumps})
