"""Batch scoring with a chosen model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import UseCase
from cohorta.learning.calibration import load_model
from cohorta.operators.cohorts import PREDICTED, PROBABILITY, VERSION
from cohorta.operators.sampling import seeded_sample
from cohorta.operators.validation import select_features, validate
from cohorta.sources.delimited import write_csv
from cohorta.sources.registry import ModelRegistry

THRESHOLD = "threshold"


class Scorer(Protocol):
    def score(self, df: DataFrame, output: str) -> DataFrame: ...


@dataclass
class RuleScorer:
    """Scores with a column expression, such as the rule benchmark."""

    expression: Callable[[], Column]

    def score(self, df: DataFrame, output: str = PROBABILITY) -> DataFrame:
        return df.withColumn(output, self.expression().cast("double"))


@dataclass
class ForeignScorer:
    """Scores with any object that has ``predict_proba``, in Arrow batches on the executors.

    The answer may be the probability of class 1 per row, or one column per class.
    """

    model: Any
    feature_columns: list[str]

    def score(self, df: DataFrame, output: str = PROBABILITY) -> DataFrame:
        model, features = self.model, list(self.feature_columns)

        @F.pandas_udf("double")
        def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(positive_class(model.predict_proba(batch[features]), len(batch)))

        return df.withColumn(output, probability(F.struct(*features)))


def positive_class(answer, rows: int) -> np.ndarray:
    """Probability of class 1 from a one- or two-column answer."""
    values = np.asarray(answer, dtype=float)
    if values.ndim == 2 and values.shape[1] == 2:
        values = values[:, 1]
    elif values.ndim == 2 and values.shape[1] == 1:
        values = values[:, 0]
    if values.shape != (rows,):
        raise ValueError(f"Expected one or two probabilities for {rows} rows, got shape {np.shape(answer)}.")
    return values


def score_rows(
    df: DataFrame, scorer: Scorer, feature_columns, threshold: float, model_version: int | None
) -> DataFrame:
    """Input columns plus probability, class, threshold and model version; no action is run."""
    select_features(df, feature_columns, "scoring input")
    scored = scorer.score(df, PROBABILITY)
    return scored.withColumns(
        {
            PREDICTED: (F.col(PROBABILITY) >= F.lit(float(threshold))).cast("int"),
            THRESHOLD: F.lit(float(threshold)),
            VERSION: F.lit(model_version).cast("int"),
        }
    )


def score_batch(
    df: DataFrame, use_case: UseCase, scorer: Scorer, threshold: float, model_version: int | None
) -> DataFrame:
    """Validate against the contract, then score."""
    rows = validate(df, use_case)
    return score_rows(rows, scorer, use_case.feature_columns, threshold, model_version)


def observe_mean_probability(scored: DataFrame) -> tuple[DataFrame, Observation]:
    """Row count and mean probability gathered while the result is written; no extra job.

    For the log only: a stage repeated after a lost executor may count rows again.
    """
    watch = Observation()
    counted = scored.observe(
        watch, F.count(F.lit(1)).alias("rows"), F.avg(PROBABILITY).alias("mean_probability")
    )
    return counted, watch


def load_scorer(
    spark: SparkSession,
    registry: ModelRegistry,
    use_case: UseCase,
    model_name: str | None = None,
    alias: str | None = None,
    version: int | None = None,
    run_record: dict | None = None,
) -> tuple[Scorer, float, int | None]:
    """(scorer, threshold, version) chosen by run record, alias or version, one of the three."""
    if run_record is not None:
        if any(x is not None for x in (model_name, alias, version)):
            raise ValueError("A run record already names its model; give no other selector.")
        model = run_record["model"]
        if model["use_case"] != use_case.name:
            raise ValueError(f"The run belongs to use case {model['use_case']!r}, not {use_case.name!r}.")
        threshold = run_record["training"]["threshold"]["value"]
        return load_model(model["reference"]["uri"], spark), threshold, model["version"]
    if model_name is None:
        raise ValueError("Give a run record or a model name.")
    found = registry.resolve(model_name, use_case.name, alias, version)
    return load_model(found["model_path"], spark), found["threshold"], found["model_version"]


def sample_scoring_run(
    df: DataFrame,
    use_case: UseCase,
    scorer: Scorer,
    threshold: float,
    model_version: int | None,
    key: str,
    sample_size: int,
    seed: int,
    folder: str,
    run_number: int,
    timestamp: str | None = None,
) -> str:
    """Score a reproducible sample and write it as the numbered run file of a folder."""
    sample = seeded_sample(df, key, sample_size, seed)
    scored = score_rows(sample, scorer, use_case.feature_columns, threshold, model_version)
    moment = F.current_timestamp() if timestamp is None else F.lit(timestamp)
    stamped = scored.withColumn(use_case.time_column, moment.cast("timestamp_ntz"))
    path = f"{folder.rstrip('/')}/{run_number:04d}_sample_predictions.csv"
    write_csv(stamped.coalesce(1), path)
    return path
