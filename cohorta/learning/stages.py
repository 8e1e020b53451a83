"""Pipeline stages Spark ML does not have: feature builder, exact imputer, population scaler.

Fitted values are plain dictionaries in a parameter, so a fitted pipeline saves and loads
like any other. Only one value per column ever reaches the driver.
"""

from __future__ import annotations

from importlib import import_module

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.functions.scalars import numeric_columns, string_columns, to_long
from cohorta.operators.profile import most_frequent
from cohorta.operators.ranks import column_percentiles

# Imputation strategies and the constants the constant strategy fills in.
NUMERIC_STRATEGIES = ("median", "mean", "most_frequent", "constant")
TEXT_STRATEGIES = ("most_frequent", "constant")
CONSTANT_NUMBER, CONSTANT_WORD = 0.0, "missing_value"


class Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Readable and writable through its parameters."""


class FeatureStage(Transformer, Saved):
    """Applies a contract's feature builder, named as ``module:function``."""

    builder = Param(Params._dummy(), "builder", "module:function", TypeConverters.toString)

    def __init__(self, builder=None):
        super().__init__()
        if builder is not None:
            self._set(builder=f"{builder.__module__}:{builder.__qualname__}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        module, name = self.getOrDefault(self.builder).split(":")
        return getattr(import_module(module), name)(dataset)


class _Fitted(Model, Saved):
    state = Param(Params._dummy(), "state", "fitted values by column", TypeConverters.identity)

    def __init__(self, state=None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def fitted(self):
        return self.getOrDefault(self.state)


class ImputerModel(_Fitted):
    """Fills missing numbers and words; numbers become doubles."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.fitted()
        filled = {
            name: F.coalesce(
                F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double")), F.lit(value)
            )
            for name, value in state["numbers"].items()
        }
        filled |= {name: F.coalesce(F.col(name), F.lit(v)) for name, v in state["words"].items()}
        return dataset.withColumns(filled)


class Imputer(Estimator, Saved):
    """Exact medians, means or most frequent values; column kinds follow the column types."""

    columns = Param(Params._dummy(), "columns", "columns to fill", TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "strategy for numbers", TypeConverters.toString)
    text = Param(Params._dummy(), "text", "strategy for words", TypeConverters.toString)

    def __init__(self, columns=None, numeric="median", text="most_frequent"):
        super().__init__()
        if numeric not in NUMERIC_STRATEGIES or text not in TEXT_STRATEGIES:
            raise ValueError(f"Unknown imputation strategy {numeric!r} / {text!r}.")
        self._set(numeric=numeric, text=text)
        if columns is not None:
            self._set(columns=list(columns))

    def _numbers(self, df: DataFrame, columns: list[str]) -> dict[str, float]:
        strategy = self.getOrDefault(self.numeric)
        if not columns or strategy == "constant":
            return dict.fromkeys(columns, CONSTANT_NUMBER)
        if strategy == "median":
            found = column_percentiles(df, columns, {"median": 0.5})
            fills = {name: values["median"] for name, values in found.items()}
            return {c: CONSTANT_NUMBER if fills[c] is None else fills[c] for c in columns}
        long = to_long(df, columns, [], "double").where(
            F.col("value").isNotNull() & ~F.isnan("value")
        )
        if strategy == "mean":
            found = long.groupBy("feature").agg(F.avg("value").alias("fill"))
        else:
            counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
            found = counts.groupBy("feature").agg(most_frequent().alias("fill"))
        fills = {row["feature"]: row["fill"] for row in found.collect()}
        return {name: fills.get(name, CONSTANT_NUMBER) for name in columns}

    def _words(self, df: DataFrame, columns: list[str]) -> dict[str, str]:
        if not columns or self.getOrDefault(self.text) == "constant":
            return dict.fromkeys(columns, CONSTANT_WORD)
        counts = (
            to_long(df, columns, [], "string")
            .where(F.col("value").isNotNull())
            .groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        found = counts.groupBy("feature").agg(most_frequent().alias("fill"))
        fills = {row["feature"]: row["fill"] for row in found.collect()}
        return {name: fills.get(name, CONSTANT_WORD) for name in columns}

    def _fit(self, dataset: DataFrame) -> ImputerModel:
        columns = self.getOrDefault(self.columns)
        return ImputerModel(
            {
                "numbers": self._numbers(dataset, numeric_columns(dataset, columns)),
                "words": self._words(dataset, string_columns(dataset, columns)),
            }
        )


class ScalerModel(_Fitted):
    """(x - mean) / deviation per column; a constant column is only centred."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {
                name: (F.col(name).cast("double") - F.lit(mean)) / F.lit(deviation or 1.0)
                for name, (mean, deviation) in self.fitted().items()
            }
        )


class PopulationScaler(Estimator, Saved):
    """Mean and population standard deviation of every column from one aggregate."""

    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)

    def __init__(self, columns=None):
        super().__init__()
        if columns is not None:
            self._set(columns=list(columns))

    def _fit(self, dataset: DataFrame) -> ScalerModel:
        columns = self.getOrDefault(self.columns)
        row = dataset.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"d_{c}") for c in columns],
        ).first()
        return ScalerModel({c: [row[f"m_{c}"] or 0.0, row[f"d_{c}"] or 0.0] for c in columns})
