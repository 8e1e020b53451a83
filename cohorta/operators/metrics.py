"""Exact binary-classification metrics over any number of rows.

Every metric starts from score counts: rows collapse map-side to one row per
(keys, score) with the number of positives and negatives. Ranking metrics then use
running totals over the descending score; the others are plain conditional sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.functions.scalars import ratio, ratio_or_zero
from cohorta.operators.prefix import quantile_cuts, running_totals


def check_inputs(threshold: float | None = None, bins: int | None = None) -> None:
    if threshold is not None and not 0 <= threshold <= 1:
        raise ValueError("The threshold must lie in [0, 1].")
    if bins is not None and bins < 1:
        raise ValueError("At least one calibration bin is needed.")


def invalid_scores(df: DataFrame, score: str) -> DataFrame:
    """One row: how many scores are missing, not finite, or outside [0, 1]."""
    value = F.col(score).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("missing"),
        F.count_if(F.isnan(value) | (F.abs(value) == F.lit(float("inf")))).alias("not_finite"),
        F.count_if(~F.isnan(value) & ((value < 0) | (value > 1))).alias("out_of_range"),
    )


def check_scores(df: DataFrame, score: str) -> None:
    bad = invalid_scores(df, score).first()
    if bad["missing"] or bad["not_finite"] or bad["out_of_range"]:
        raise ValueError(f"Scores must be finite and in [0, 1]: {bad.asDict()}.")


def rows_where(condition: Column, rows: str | None = None) -> Column:
    """How many rows meet the condition; each counts as often as its column ``rows`` says, if there is one."""
    if rows is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(rows))), F.lit(0))


def score_counts(df: DataFrame, target: str, score: str, keys: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """(keys, score, pos, neg): labelled rows collapsed by score."""
    return (
        df.where(F.col(target).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(
            rows_where(F.col(target) == 1, rows).alias("pos"),
            rows_where(F.col(target) == 0, rows).alias("neg"),
        )
    )


def ranked(counts: DataFrame, cuts: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Score counts with running and total positives / negatives, best score first."""
    return running_totals(counts, "score", ["pos", "neg"], keys, descending=True, cuts=cuts)


def ranked_scores(df: DataFrame, target: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    return ranked(score_counts(df, target, score, keys), quantile_cuts(df, score), keys)


# Aggregates over ``ranked``: totals per group, hits and false alarms down to each score.
def _number(name: str) -> Column:
    return F.col(name).cast("double")


def _positives() -> Column:
    return F.max(_number("total_pos"))


def _negatives() -> Column:
    return F.max(_number("total_neg"))


def roc_auc_value() -> Column:
    """Area under the ROC curve, ties count one half; null when a class is absent."""
    above = F.sum(_number("neg") * (_number("running_pos") - _number("pos") / 2))
    return ratio(above, _positives() * _negatives())


def average_precision_value() -> Column:
    """Step-wise area under the precision-recall curve; null without positives."""
    hits = _number("running_pos")
    weighted = F.sum(_number("pos") * ratio(hits, hits + _number("running_neg")))
    return ratio(weighted, _positives())


def best_f1() -> Column:
    """Struct (f1, score) of the best cut; the highest score wins a tie."""
    hits = _number("running_pos")
    f1 = ratio_or_zero(2 * hits, hits + _number("running_neg") + _number("total_pos"))
    return F.max(F.struct(f1.alias("f1"), F.col("score").alias("score")))


def roc_auc(df: DataFrame, target: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    return ranked_scores(df, target, score, keys).groupBy(*keys).agg(roc_auc_value().alias("roc_auc"))


def average_precision(df: DataFrame, target: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    return (
        ranked_scores(df, target, score, keys)
        .groupBy(*keys)
        .agg(average_precision_value().alias("pr_auc"))
    )


def max_f1_threshold(df: DataFrame, target: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest F1; null where only one class is present."""
    both = (_positives() > 0) & (_negatives() > 0)
    return (
        ranked_scores(df, target, score, keys)
        .groupBy(*keys)
        .agg(F.when(both, best_f1()).alias("best"))
        .select(*keys, F.col("best.score").alias("threshold"), F.col("best.f1").alias("f1"))
    )


def threshold_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def _threshold_sums(threshold: float) -> dict[str, Column]:
    hit = F.col("score") >= F.lit(float(threshold))
    return threshold_columns(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))),
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def classification_metrics(
    df: DataFrame, target: str, score: str, threshold: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1 at score >= threshold; map-side sums only."""
    check_inputs(threshold=threshold)
    labelled = df.where(F.col(target).isNotNull())
    hit = F.col(score) >= F.lit(float(threshold))
    positive = F.col(target) == 1
    return labelled.groupBy(*keys).agg(
        *_named(
            threshold_columns(
                F.count_if(hit & positive),
                F.count_if(hit & ~positive),
                F.count_if(~hit & positive),
                F.count_if(~hit & ~positive),
            )
        )
    )


def brier(df: DataFrame, target: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    gap = F.col(score) - F.col(target)
    return (
        df.where(F.col(target).isNotNull())
        .groupBy(*keys)
        .agg(F.avg(gap * gap).alias("brier_score"))
    )


def calibration_bin(score: Column, bins: int) -> Column:
    """1-based equal-width bin, right-closed; zero falls in the first bin."""
    return F.greatest(F.ceil(score * bins), F.lit(1)).cast("int")


def calibration_curve(
    df: DataFrame, target: str, score: str, bins: int = 10, keys: Sequence[str] = ()
) -> DataFrame:
    """Non-empty bins with mean prediction, share of positives and row count."""
    check_inputs(bins=bins)
    return (
        df.where(F.col(target).isNotNull())
        .groupBy(*keys, calibration_bin(F.col(score), bins).alias("bin"))
        .agg(
            F.avg(score).alias("mean_prediction"),
            F.avg(F.col(target).cast("double")).alias("positive_share"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def calibration_error(
    df: DataFrame, target: str, score: str, bins: int = 10, keys: Sequence[str] = ()
) -> DataFrame:
    """Expected calibration error: count-weighted mean gap over non-empty bins."""
    gap = F.abs(F.col("mean_prediction") - F.col("positive_share")) * F.col("rows")
    return (
        calibration_curve(df, target, score, bins, keys)
        .groupBy(*keys)
        .agg(ratio(F.sum(gap), F.sum("rows")).alias("calibration_error"))
    )


def _brier_sum() -> Column:
    miss_pos = F.col("pos") * (1 - F.col("score")) * (1 - F.col("score"))
    miss_neg = F.col("neg") * F.col("score") * F.col("score")
    return ratio(F.sum(miss_pos + miss_neg), F.sum(F.col("pos") + F.col("neg")))


def calibration_error_value(bins: int, score: str = "score") -> Column:
    """Same value as ``calibration_error`` as one aggregate over score counts."""
    of = calibration_bin(F.col(score), bins)
    surplus = F.col(score) * (F.col("pos") + F.col("neg")) - F.col("pos")
    gaps = [F.abs(F.sum(F.when(of == b, surplus).otherwise(0.0))) for b in range(1, bins + 1)]
    total = gaps[0]
    for gap in gaps[1:]:
        total = total + gap
    return ratio(total, F.sum(F.col("pos") + F.col("neg")))


def evaluation_row(
    df: DataFrame,
    target: str,
    score: str,
    threshold: float,
    bins: int = 10,
    keys: Sequence[str] = (),
    fit_time_sec: float | None = None,
    pred_time_sec: float | None = None,
) -> DataFrame:
    """All metrics per group from one ranked pass over the score counts."""
    check_inputs(threshold, bins)
    return (
        ranked_scores(df, target, score, keys)
        .groupBy(*keys)
        .agg(
            roc_auc_value().alias("roc_auc"),
            average_precision_value().alias("pr_auc"),
            *_named(_threshold_sums(threshold)),
            _brier_sum().alias("brier_score"),
            calibration_error_value(bins).alias("calibration_error"),
        )
        .withColumns(
            {
                "threshold": F.lit(float(threshold)),
                "fit_time_sec": F.lit(fit_time_sec).cast("double"),
                "pred_time_sec": F.lit(pred_time_sec).cast("double"),
            }
        )
    )


def confusion_matrix(df: DataFrame, target: str, predicted: str) -> DataFrame:
    """One row per actual class with the counts of predicted 0 and predicted 1."""
    return (
        df.groupBy(F.col(target).alias("actual"))
        .agg(
            F.count_if(F.col(predicted) == 0).alias("predicted_0"),
            F.count_if(F.col(predicted) == 1).alias("predicted_1"),
        )
    )
