"""Seeded guided search over a classifier's search space on expanding-window folds."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from cohorta.contracts import UseCase
from cohorta.learning.catalog import CATALOG, WITHOUT_PROBABILITY
from cohorta.learning.folds import temporal_folds
from cohorta.learning.parzen import STARTUP, guided_draw
from cohorta.learning.pipelines import fit_pipeline
from cohorta.learning.settings import JobPlan
from cohorta.operators.metrics import average_precision, roc_auc
from cohorta.session import cache_balanced


BATCH = 4  # guided trials drawn together


@dataclass(frozen=True)
class TuningResult:
    best_params: dict[str, Any]
    best_score: float
    metric: str
    n_trials: int
    n_splits: int
    time_column: str
    random_state: int


def draw(space: Mapping[str, Mapping[str, Any]], generator: random.Random) -> dict[str, Any]:
    """One parameter set."""
    chosen: dict[str, Any] = {}
    for name, part in space.items():
        if part["type"] == "categorical":
            chosen[name] = generator.choice(part["choices"])
            continue
        if part["type"] not in {"int", "float"}:
            raise ValueError(f"Unknown search type {part['type']!r} for {name!r}.")
        low, high = part["low"], part["high"]
        if part["log"]:
            value = math.exp(generator.uniform(math.log(low), math.log(high)))
        else:
            value = generator.uniform(low, high + 1) if part["type"] == "int" else generator.uniform(low, high)
        chosen[name] = min(int(value), high) if part["type"] == "int" else value
    return chosen


def optimize(use_case: UseCase, config: JobPlan, train: DataFrame) -> TuningResult:
    """Best drawn parameters by mean validation metric; every trial is a set of distributed fits.

    The first trials are random, then batches of ``BATCH`` are drawn by what the trials before the batch scored. A batch
    has one size whatever runs at once, so the result does not depend on the parallelism.
    """
    fitting, search = config.fitting, config.search
    alias = fitting.model
    space = CATALOG.get(alias, {}).get("space")
    if not space:
        raise ValueError(f"Classifier {alias!r} has no search space.")
    target, time = use_case.target_column, use_case.time_column
    train = cache_balanced(train.select(*use_case.feature_columns, target, time))
    folds = temporal_folds(train, target, time, search.folds)
    generator = random.Random(search.seed)
    metric = roc_auc if search.metric == "roc_auc" else average_precision

    def mean_score(params: dict[str, Any]) -> float:
        values = []
        for fold in folds:
            history, later = fold.split(train, time)
            fitted, _ = fit_pipeline(
                use_case, alias, {**fitting.params, **params}, history,
                fitting.fill_numbers, fitting.fill_words,
            )
            rank = fitted.margin if alias in WITHOUT_PROBABILITY else fitted.score
            values.append(metric(rank(later, "score"), target, "score").first()[0])
        return sum(values) / len(values)

    with ThreadPoolExecutor(max_workers=search.parallelism) as pool:
        task = inheritable_thread_target(train.sparkSession)(mean_score)
        trials: list[dict[str, Any]] = []
        scores: list[float] = []
        while len(trials) < search.trials:
            if not trials:
                batch = [draw(space, generator) for _ in range(min(STARTUP, search.trials))]
            else:
                done = list(zip(trials, scores, strict=True))
                batch = [guided_draw(space, done, generator) for _ in range(min(BATCH, search.trials - len(trials)))]
            scores += pool.map(task, batch)
            trials += batch
    train.unpersist()
    best = max(range(len(trials)), key=lambda i: (scores[i], -i))
    return TuningResult(
        best_params=trials[best],
        best_score=scores[best],
        metric=search.metric,
        n_trials=search.trials,
        n_splits=search.folds,
        time_column=time,
        random_state=search.seed,
    )
