"""Quality scores, promotion decisions and model versions over run tables."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metrics where smaller is better, default weights, default required gain.
LOWER_IS_BETTER = ("brier_score", "calibration_error")
DEFAULT_WEIGHTS = {
    "roc_auc": 0.2,
    "pr_auc": 0.2,
    "f1": 0.2,
    "brier_score": 0.2,
    "calibration_error": 0.2,
}
DEFAULT_MIN_DELTA = 0.005

CHAMPION, FORMER_CHAMPION = "champion", "former_champion"

FIRST_CHAMPION = "no champion existed"
NOT_COMPARABLE = "champion metrics are missing"
IMPROVED = "improvement above the required delta"
NOT_IMPROVED = "no improvement above the required delta"
INVALID = "candidate metrics are missing or invalid"


def check_weights(weights: Mapping[str, float]) -> None:
    if not weights or any(not math.isfinite(w) or w < 0 for w in weights.values()):
        raise ValueError("Metric weights must be finite, non-negative and not empty.")
    if sum(weights.values()) <= 0:
        raise ValueError("Metric weights need a positive total.")


def weighted_scores(metrics: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS) -> DataFrame:
    """(run_id, missing, invalid, score) from a long (run_id, metric, value) table.

    Error metrics count as one minus their value. The score is null where a weighted metric is
    missing or lies outside [0, 1].
    """
    check_weights(weights)
    weight, oriented = F.lit(None).cast("double"), F.col("value")
    for name, share in weights.items():
        weight = F.when(F.col("metric") == name, F.lit(float(share))).otherwise(weight)
    oriented = F.when(F.col("metric").isin(*LOWER_IS_BETTER), 1 - oriented).otherwise(oriented)
    usable = F.col("value").between(0, 1) & ~F.isnan("value")
    weighed = metrics.withColumns({"_w": weight, "_v": oriented})
    return (
        weighed.groupBy("run_id")
        .agg(
            (F.lit(len(weights)) - F.count("_w")).cast("int").alias("missing"),
            F.count_if(F.col("_w").isNotNull() & ~F.coalesce(usable, F.lit(False))).cast("int").alias("invalid"),
            (F.sum(F.col("_w") * F.col("_v")) / sum(weights.values())).alias("_score"),
        )
        .select(
            "run_id",
            "missing",
            "invalid",
            F.when((F.col("missing") == 0) & (F.col("invalid") == 0), F.col("_score")).alias("score"),
        )
    )


def promotion_columns(
    candidate: Column, champion: Column, has_champion: Column, min_delta: float
) -> dict[str, Column]:
    """Score gain, decision and reason; the gain must be strictly above the required delta.

    Scores are compared after rounding to twelve decimals, so that equality is not decided by
    the last bit of a sum.
    """
    delta = F.round(candidate - champion, 12)
    better = delta > F.lit(min_delta)
    reason = (
        F.when(candidate.isNull(), INVALID)
        .when(~has_champion, FIRST_CHAMPION)
        .when(champion.isNull(), NOT_COMPARABLE)
        .when(better, IMPROVED)
        .otherwise(NOT_IMPROVED)
    )
    return {
        "score_delta": F.when(has_champion, delta),
        "promote": reason.isin(FIRST_CHAMPION, IMPROVED),
        "reason": reason,
    }


def promotion_decisions(
    pairs: DataFrame, scores: DataFrame, min_delta: float = DEFAULT_MIN_DELTA
) -> DataFrame:
    """Decision per (run_id, champion_run_id) pair; a null champion means there is none yet."""
    if not math.isfinite(min_delta) or min_delta < 0:
        raise ValueError("The required delta must be finite and non-negative.")
    candidates = scores.select("run_id", F.col("score").alias("candidate_score"))
    champions = scores.select(
        F.col("run_id").alias("champion_run_id"), F.col("score").alias("champion_score")
    )
    joined = pairs.join(candidates, "run_id", "left").join(champions, "champion_run_id", "left")
    return joined.withColumn("min_delta", F.lit(min_delta)).withColumns(
        promotion_columns(
            F.col("candidate_score"),
            F.col("champion_score"),
            F.col("champion_run_id").isNotNull(),
            min_delta,
        )
    )


def current_aliases(history: DataFrame) -> DataFrame:
    """Latest version per (model_name, alias) of an append-only alias history.

    Of versions assigned at one time the highest number counts, whatever the order of the rows.
    """
    return history.groupBy("model_name", "alias").agg(
        F.max_by("model_version", F.struct("assigned_at", "model_version")).alias("model_version"),
        F.max("assigned_at").alias("assigned_at"),
    )


def next_versions(versions: DataFrame) -> DataFrame:
    """The version number a model's next registration gets."""
    return versions.groupBy("model_name").agg((F.max("model_version") + 1).alias("next_version"))


def resolve_models(requests: DataFrame, versions: DataFrame, aliases: DataFrame) -> DataFrame:
    """Model version, run and threshold for (model_name, alias or model_version) requests.

    ``problem`` says why a request cannot be served: both or neither selector given, nothing
    found, or another use case.
    """
    current = current_aliases(aliases).select(
        "model_name", "alias", F.col("model_version").alias("_aliased")
    )
    chosen = requests.join(current, ["model_name", "alias"], "left").withColumn(
        "_version", F.coalesce("model_version", "_aliased")
    )
    known = versions.select(
        F.col("model_name"),
        F.col("model_version").alias("_version"),
        "run_id",
        "threshold",
        F.col("use_case").alias("_use_case"),
    )
    found = chosen.join(known, ["model_name", "_version"], "left")
    problem = (
        F.when(F.col("alias").isNull() == F.col("model_version").isNull(), "ambiguous selector")
        .when(F.col("run_id").isNull(), "not found")
        .when(F.col("_use_case") != F.col("use_case"), "other use case")
    )
    return found.select(
        "model_name",
        "use_case",
        "alias",
        F.col("model_version").alias("requested_version"),
        F.when(problem.isNull(), F.col("_version")).alias("model_version"),
        F.when(problem.isNull(), F.col("run_id")).alias("run_id"),
        F.when(problem.isNull(), F.col("threshold")).alias("threshold"),
        problem.alias("problem"),
    )


def metrics_by_alias(aliases: DataFrame, versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """(model_name, alias, metric, value) of the versions the aliases point to."""
    runs = current_aliases(aliases).join(versions, ["model_name", "model_version"])
    return runs.join(metrics, "run_id").select("model_name", "alias", "metric", "value")
