"""Probability calibration on historical folds, averaged over the folds."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import UseCase
from cohorta.learning.catalog import WITHOUT_PROBABILITY
from cohorta.learning.folds import temporal_folds
from cohorta.learning.pipelines import FittedPipeline, fit_pipeline, without_summary
from cohorta.operators.isotonic import IsotonicMap
from cohorta.operators.metrics import score_counts
from cohorta.operators.scores import fit_isotonic

# Calibration methods.
METHODS = ("none", "sigmoid", "isotonic")


def fit_sigmoid(df: DataFrame, target: str, score: str) -> LogisticRegressionModel:
    """One-dimensional logistic fit on smoothed targets.

    Rows collapse to distinct scores; each stands for a positive and a negative example weighted
    by the smoothed target and its complement.
    """
    counts = score_counts(df, target, score)
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    high, low = (totals["p"] + 1) / (totals["p"] + 2), 1 / (totals["n"] + 2)
    positive = F.col("pos") * high + F.col("neg") * low
    negative = F.col("pos") + F.col("neg") - positive
    both = F.array(
        F.struct(F.lit(1.0).alias("label"), positive.alias("weight")),
        F.struct(F.lit(0.0).alias("label"), negative.alias("weight")),
    )
    points = VectorAssembler(inputCols=["score"], outputCol="features").transform(
        counts.select("score", F.inline(both))
    )
    return without_summary(LogisticRegression(weightCol="weight", regParam=0.0, maxIter=100).fit(points))


@dataclass
class CalibratedMember:
    """One fold: its pipeline and the map from its score to a probability."""

    pipeline: FittedPipeline
    calibrator: Any

    def score(self, df: DataFrame, output: str) -> DataFrame:
        columns = df.columns
        rows = self.pipeline.margin(df, "score")
        if isinstance(self.calibrator, IsotonicMap):
            mapped = self.calibrator.transform(rows, output)
        else:
            # the fitted logistic curve as an expression; keeps the caller's column names free
            intercept, slope = self.calibrator.intercept, float(self.calibrator.coefficients[0])
            mapped = rows.withColumn(output, 1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * F.col("score")))))
        return mapped.select(*columns, output)


@dataclass
class CalibratedEnsemble:
    """Mean of the fold probabilities."""

    members: list[CalibratedMember]

    @property
    def names_out(self) -> list[str]:
        return self.members[0].pipeline.names_out

    def score(self, df: DataFrame, output: str = "predicted_probability") -> DataFrame:
        rows, parts = df, []
        for i, member in enumerate(self.members):
            parts.append(f"_fold_{i}")
            rows = member.score(rows, parts[-1])
        mean = sum((F.col(p) for p in parts), F.lit(0.0)) / len(parts)
        return rows.select(*df.columns, mean.alias(output))


def fit_with_calibration(
    use_case: UseCase,
    alias: str,
    params: Mapping[str, Any] | None,
    train: DataFrame,
    method: str = "none",
    n_splits: int = 4,
    numeric_strategy: str = "median",
    text_strategy: str = "most_frequent",
) -> tuple[FittedPipeline | CalibratedEnsemble, dict[str, Any]]:
    """Fit directly, or one pipeline and one calibrator per historical fold."""
    if method not in METHODS:
        raise ValueError(f"Unknown calibration method {method!r}; expected one of {METHODS}.")
    if method == "none":
        if alias in WITHOUT_PROBABILITY:
            raise ValueError(f"Classifier {alias!r} has no probabilities; choose a calibration method.")
        return fit_pipeline(use_case, alias, params, train, numeric_strategy, text_strategy)
    target, time = use_case.target_column, use_case.time_column
    members, config = [], {}
    for fold in temporal_folds(train, target, time, n_splits):
        history, later = fold.split(train, time)
        fitted, config = fit_pipeline(use_case, alias, params, history, numeric_strategy, text_strategy)
        scored = fitted.margin(later, "score").select("score", target)
        fit = fit_sigmoid if method == "sigmoid" else fit_isotonic
        members.append(CalibratedMember(fitted, fit(scored, target, "score")))
    return CalibratedEnsemble(members), config


def save_model(model: FittedPipeline | CalibratedEnsemble, path: str, spark: SparkSession) -> None:
    """Write a fitted model below a shared folder."""
    members = model.members if isinstance(model, CalibratedEnsemble) else [model]
    kinds = []
    for i, member in enumerate(members):
        pipeline = member.pipeline if isinstance(member, CalibratedMember) else member
        pipeline.model.write().overwrite().save(f"{path}/{i}/pipeline")
        kind = "none"
        if isinstance(member, CalibratedMember):
            kind = "isotonic" if isinstance(member.calibrator, IsotonicMap) else "sigmoid"
            writer = member.calibrator if kind == "isotonic" else member.calibrator.write().overwrite()
            writer.save(f"{path}/{i}/calibrator")
        kinds.append(kind)
    first = members[0].pipeline if isinstance(members[0], CalibratedMember) else members[0]
    about = {"kinds": kinds, "alias": first.alias, "features": first.feature_columns}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/about")


def load_model(path: str, spark: SparkSession) -> FittedPipeline | CalibratedEnsemble:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    members = []
    for i, kind in enumerate(about["kinds"]):
        pipeline = FittedPipeline(
            PipelineModel.load(f"{path}/{i}/pipeline"), about["alias"], about["features"]
        )
        if kind == "none":
            return pipeline
        place = f"{path}/{i}/calibrator"
        calibrator = IsotonicMap.load(place, spark) if kind == "isotonic" else LogisticRegressionModel.load(place)
        members.append(CalibratedMember(pipeline, calibrator))
    return CalibratedEnsemble(members)
