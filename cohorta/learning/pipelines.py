"""Features, preprocessing and classifier as one Spark ML pipeline, and what it scores."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import UseCase
from cohorta.functions.scalars import numeric_columns, string_columns
from cohorta.learning.catalog import MARGIN_BASED, SCALED, WITHOUT_PROBABILITY, create_classifier
from cohorta.learning.categories import CategoryTable, CategoryTableModel
from cohorta.learning.stages import FeatureStage, Imputer, PopulationScaler
from cohorta.operators.validation import select_features

CATEGORIES = ("list", "table")


def preprocessing_stages(
    use_case: UseCase,
    sample: DataFrame,
    scale: bool,
    numeric_strategy: str = "median",
    text_strategy: str = "most_frequent",
    categories: str = "list",
) -> list:
    """Stages from raw feature columns to the ``features`` vector.

    ``sample`` is only asked for its schema. Unknown categories become all zeros. Categories are kept as a
    ``list`` in the model or, for columns with very many labels, as a ``table``; the vectors are the same.
    """
    if categories not in CATEGORIES:
        raise ValueError(f"Categories are kept as one of {CATEGORIES}, not {categories!r}.")
    built = use_case.feature_builder(sample.select(*use_case.feature_columns))
    numeric, text = numeric_columns(built), string_columns(built)
    stages: list = [
        FeatureStage(use_case.feature_builder),
        Imputer([*numeric, *text], numeric_strategy, text_strategy),
    ]
    if scale and numeric:
        stages.append(PopulationScaler(numeric))
    inputs = list(numeric)
    if text:
        indexed, hot = [f"_index_{c}" for c in text], [f"_hot_{c}" for c in text]
        indexer = (
            CategoryTable(text, indexed)
            if categories == "table"
            else StringIndexer(
                inputCols=text, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages += [indexer, OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True)]
        inputs += hot
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def feature_names_out(model: PipelineModel) -> list[str]:
    """Numeric names, then ``column_category`` names, in vector order; only here does a table become a list."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = [c for c in assembler.getInputCols() if not c.startswith("_hot_")]
    for stage in model.stages:
        if type(stage).__name__ == "StringIndexerModel":
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"{column}_{label}" for label in labels]
        if isinstance(stage, CategoryTableModel):
            table = stage.table(SparkSession.active())
            for column in stage.fitted()["inputs"]:
                own = table.where(F.col("column") == column).orderBy("number").select("label")
                names += [f"{column}_{row['label']}" for row in own.toLocalIterator()]
    return names


@dataclass
class FittedPipeline:
    """A fitted pipeline that scores rows without changing their columns."""

    model: PipelineModel
    alias: str
    feature_columns: list[str]

    @property
    def names_out(self) -> list[str]:
        return feature_names_out(self.model)

    def _with(self, df: DataFrame, output: str, column: str) -> DataFrame:
        rows = df.withColumn("_input", F.struct(*df.columns))
        scored = self.model.transform(rows.select(*self.feature_columns, "_input"))
        return scored.select("_input.*", vector_to_array(F.col(column))[1].alias(output))

    def margin(self, df: DataFrame, output: str) -> DataFrame:
        """Score used for ranking and calibration: the margin where the learner has one."""
        return self._with(df, output, "rawPrediction" if self.alias in MARGIN_BASED else "probability")

    def score(self, df: DataFrame, output: str = "predicted_probability") -> DataFrame:
        if self.alias in WITHOUT_PROBABILITY:
            raise ValueError(f"Classifier {self.alias!r} has no probabilities; calibrate it.")
        return self._with(df, output, "probability")


def without_summary(model: Model) -> Model:
    """The fitted model without its training summary.

    A summary holds the session, which cannot be sent to tasks once it has made an observation.
    """
    if isinstance(model, PipelineModel):
        for stage in model.stages:
            without_summary(stage)
        return model
    java = getattr(model, "_java_obj", None)
    if java is not None and getattr(model, "hasSummary", False):
        java.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def fit_pipeline(
    use_case: UseCase,
    alias: str,
    params: Mapping[str, Any] | None,
    train: DataFrame,
    numeric_strategy: str = "median",
    text_strategy: str = "most_frequent",
    categories: str = "list",
) -> tuple[FittedPipeline, dict[str, Any]]:
    """Fit features, preprocessing and classifier on the training rows."""
    select_features(train, use_case.feature_columns, "training data")
    target = use_case.target_column
    rows = train.select(*use_case.feature_columns, target)
    classes = rows.agg(F.count(target).alias("rows"), F.min(target), F.max(target)).first()
    if classes[1] == classes[2]:
        raise ValueError("Training data must hold both classes.")
    classifier, config = create_classifier(alias, params, target, classes["rows"])
    stages = preprocessing_stages(
        use_case, rows, alias in SCALED, numeric_strategy, text_strategy, categories
    )
    model = without_summary(Pipeline(stages=[*stages, classifier]).fit(rows))
    return FittedPipeline(model, alias, list(use_case.feature_columns)), config
