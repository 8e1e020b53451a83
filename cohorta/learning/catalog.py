"""Classifier catalogue: alias, defaults, search space and the Spark estimator behind it."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)

from cohorta.learning.boosting import HistogramBoosting
from cohorta.learning.classifiers import (
    BoostedStumps,
    GaussianBayes,
    LinearDiscriminant,
    MajorityClassifier,
    QuadraticDiscriminant,
)
from cohorta.learning.extra_trees import ExtraTrees
from cohorta.learning.kernels import COMPONENTS, OUTPUT, FourierFeatures
from cohorta.learning.neighbours import NearestNeighbours

RANDOM_STATE = 26
DEEPEST = 30  # the deepest tree Spark ML grows


def _float(low, high, log=False):
    return {"type": "float", "low": low, "high": high, "log": log}


def _int(low, high):
    return {"type": "int", "low": low, "high": high, "log": False}


def _choice(*choices):
    return {"type": "categorical", "choices": list(choices)}


# Aliases, default parameters and search ranges of the catalogue.
CATALOG: dict[str, dict[str, Any]] = {
    "dc": {"defaults": {"strategy": "most_frequent"}, "space": {}},
    "nb": {"defaults": {}, "space": {"var_smoothing": _float(1e-12, 1e-6, log=True)}},
    "lr": {
        "defaults": {"random_state": RANDOM_STATE, "max_iter": 100},
        "space": {"C": _float(1e-4, 1e2, log=True)},
    },
    "lsvc": {"defaults": {"random_state": RANDOM_STATE}, "space": {"C": _float(1e-4, 1e2, log=True)}},
    "svc": {
        "defaults": {"random_state": RANDOM_STATE, "kernel": "rbf"},
        "space": {"C": _float(1e-4, 1e2, log=True)},
    },
    "dt": {
        "defaults": {"random_state": RANDOM_STATE},
        "space": {"max_depth": _choice(None, 3, 5, 10, 20), "min_samples_leaf": _int(5, 100)},
    },
    "ada": {
        "defaults": {"random_state": RANDOM_STATE, "n_estimators": 100},
        "space": {"n_estimators": _int(50, 500), "learning_rate": _float(0.01, 2.0, log=True)},
    },
    "et": {
        "defaults": {"random_state": RANDOM_STATE},
        "space": {
            "n_estimators": _int(50, 500),
            "max_depth": _choice(None, 5, 10, 20),
            "min_samples_leaf": _int(5, 100),
            "max_features": _choice("sqrt", "log2", None),
        },
    },
    "rf": {
        "defaults": {"random_state": RANDOM_STATE},
        "space": {
            "n_estimators": _int(50, 500),
            "max_depth": _choice(None, 5, 10, 20),
            "min_samples_leaf": _int(5, 100),
            "max_features": _choice("sqrt", "log2", None),
        },
    },
    "hgb": {
        "defaults": {"random_state": RANDOM_STATE},
        "space": {
            "max_iter": _int(50, 500),
            "learning_rate": _float(0.01, 0.3, log=True),
            "max_leaf_nodes": _int(16, 64),
            "l2_regularization": _float(1e-8, 10.0, log=True),
        },
    },
    "knn": {
        "defaults": {"n_neighbors": 5, "weights": "uniform"},
        "space": {"n_neighbors": _int(3, 25), "weights": _choice("uniform", "distance")},
    },
    "lda": {"defaults": {}, "space": {"tol": _float(1e-5, 1e-1, log=True)}},
    "qda": {"defaults": {"reg_param": 0.1}, "space": {"reg_param": _float(0.0, 1.0)}},
}

# Aliases whose linear or distance geometry needs standardised numbers.
SCALED = ("lr", "lsvc", "svc", "knn")
# Aliases whose calibration starts from the margin instead of the probability.
MARGIN_BASED = ("lr", "lsvc", "svc", "hgb", "ada", "lda", "qda")
WITHOUT_PROBABILITY = ("lsvc", "svc")


def _depth(value) -> int:
    """No depth means the deepest tree there is; a deeper one cannot be had."""
    if value is not None and int(value) > DEEPEST:
        raise ValueError(f"Trees grow to a depth of {DEEPEST}, not {value}.")
    return DEEPEST if value is None else int(value)


def _estimator(alias: str, p: Mapping[str, Any], label: str, rows: int) -> Estimator:
    columns = {"featuresCol": "features", "labelCol": label}
    seed = p.get("random_state", RANDOM_STATE)
    penalty = 1.0 / (p.get("C", 1.0) * max(rows, 1))
    if alias == "dc":
        return MajorityClassifier(labelCol=label)
    if alias == "nb":
        return GaussianBayes(labelCol=label, var_smoothing=p.get("var_smoothing", 1e-9))
    if alias == "lr":
        return LogisticRegression(
            **columns, regParam=penalty, elasticNetParam=0.0, maxIter=p["max_iter"],
            tol=p.get("tol", 1e-4), standardization=False,
        )
    if alias == "lsvc":
        return LinearSVC(
            **columns, regParam=penalty, maxIter=p.get("max_iter", 100), tol=p.get("tol", 1e-4),
            standardization=False,
        )
    if alias == "svc":
        if p["kernel"] != "rbf":
            raise ValueError(f"Kernel {p['kernel']!r} is not offered; 'lsvc' is linear.")
        margin = LinearSVC(
            featuresCol=OUTPUT, labelCol=label, regParam=penalty, maxIter=p.get("max_iter", 100),
            tol=p.get("tol", 1e-4), standardization=False,
        )
        return Pipeline(stages=[FourierFeatures(seed, p.get("components", COMPONENTS)), margin])
    if alias == "dt":
        return DecisionTreeClassifier(
            **columns, seed=seed, maxDepth=_depth(p.get("max_depth")),
            minInstancesPerNode=p.get("min_samples_leaf", 1), maxBins=p.get("max_bins", 255),
        )
    if alias == "rf":
        subset = {"sqrt": "sqrt", "log2": "log2", None: "all"}[p.get("max_features", "sqrt")]
        return RandomForestClassifier(
            **columns, seed=seed, numTrees=p.get("n_estimators", 100), maxDepth=_depth(p.get("max_depth")),
            minInstancesPerNode=p.get("min_samples_leaf", 1), featureSubsetStrategy=subset,
            maxBins=p.get("max_bins", 255),
        )
    if alias == "et":
        return ExtraTrees(labelCol=label, **p)
    if alias == "hgb":
        return HistogramBoosting(labelCol=label, **{k: v for k, v in p.items() if k != "random_state"})
    if alias == "ada":
        return BoostedStumps(
            labelCol=label, n_estimators=p["n_estimators"], learning_rate=p.get("learning_rate", 1.0),
            random_state=seed,
        )
    if alias == "knn":
        return NearestNeighbours(labelCol=label, n_neighbors=p["n_neighbors"], weights=p["weights"])
    if alias == "lda":
        return LinearDiscriminant(labelCol=label, tol=p.get("tol", 1e-4))
    return QuadraticDiscriminant(labelCol=label, reg_param=p["reg_param"])


def create_classifier(
    alias: str, params: Mapping[str, Any] | None, label: str, rows: int
) -> tuple[Estimator, dict[str, Any]]:
    """Estimator and its effective settings; overrides win over the catalogue defaults.

    ``rows`` is the number of training rows: the inverse penalty C of the catalogue is a total,
    Spark's penalty is per row.
    """
    if alias not in CATALOG:
        raise ValueError(f"No classifier {alias!r}; known aliases: {', '.join(CATALOG)}.")
    merged = {**CATALOG[alias]["defaults"], **(params or {})}
    estimator = _estimator(alias, merged, label, rows)
    last = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    return estimator, {"model_alias": alias, "model_name": type(last).__name__, **merged}
