"""Ranking, threshold and calibration metrics over the scored line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.functions.features import rule_classifier
from cohorta.operators import metrics as M
from cohorta.plans import views as V
from registered.derived import CUSTOMERS, SCORED, with_views

Y, P, THRESHOLD, BINS = "returned", "predicted_probability", 0.5, 10


def rounded(df, digits=6):
    """Round every fractional column."""
    return df.withColumns(
        {n: F.round(F.round(n, 10), digits) for n, kind in df.dtypes if kind == "double"}
    )


def _scored(spark, sf_dir):
    return V.scored(spark, sf_dir)


def roc_auc(spark, sf_dir):
    return rounded(M.roc_auc(_scored(spark, sf_dir), Y, P))


def average_precision(spark, sf_dir):
    return rounded(M.average_precision(_scored(spark, sf_dir), Y, P))


def classification_metrics(spark, sf_dir):
    return rounded(M.classification_metrics(_scored(spark, sf_dir), Y, P, THRESHOLD))


def brier(spark, sf_dir):
    return rounded(M.brier(_scored(spark, sf_dir), Y, P))


def calibration_curve(spark, sf_dir):
    return rounded(M.calibration_curve(_scored(spark, sf_dir), Y, P, BINS))


def calibration_error(spark, sf_dir):
    return rounded(M.calibration_error(_scored(spark, sf_dir), Y, P, BINS))


def max_f1_threshold(spark, sf_dir):
    return rounded(M.max_f1_threshold(_scored(spark, sf_dir), Y, P))


def evaluation_row(spark, sf_dir):
    row = M.evaluation_row(_scored(spark, sf_dir), Y, P, THRESHOLD, BINS)
    return rounded(row.drop("fit_time_sec", "pred_time_sec"))


def score_checks(spark, sf_dir):
    return M.invalid_scores(_scored(spark, sf_dir), P)


def model_comparison(spark, sf_dir):
    """One metric row per model; the supplier number stands for eight models."""
    rows = _scored(spark, sf_dir).withColumn("model", (F.col("l_suppkey") % 8).cast("int"))
    compared = M.evaluation_row(rows, Y, P, THRESHOLD, BINS, ["model"])
    return rounded(compared.drop("fit_time_sec", "pred_time_sec"))


def rule_classifier_rates(spark, sf_dir):
    rows = V.customers(spark, sf_dir).withColumn("predicted", rule_classifier())
    return rows.groupBy("contract_length", "predicted").agg(F.count(F.lit(1)).alias("rows"))


def confusion_matrix(spark, sf_dir):
    rows = V.customers(spark, sf_dir).withColumn("predicted", rule_classifier())
    return M.confusion_matrix(rows, "churn", "predicted")


QUERIES = {
    "roc_auc": roc_auc,
    "average_precision": average_precision,
    "classification_metrics": classification_metrics,
    "brier": brier,
    "calibration_curve": calibration_curve,
    "calibration_error": calibration_error,
    "max_f1_threshold": max_f1_threshold,
    "evaluation_row": evaluation_row,
    "score_checks": score_checks,
    "model_comparison": model_comparison,
    "rule_classifier": rule_classifier_rates,
    "confusion_matrix": confusion_matrix,
}

_S = "s AS (SELECT returned AS y, predicted_probability AS p, l_suppkey % 8 AS model FROM scored)"


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round(round({expression}, 10), {digits}) AS {name}"


def _metrics(group: str) -> str:
    """All metrics per group, each by its own formula (rank sums, self-joined counts)."""
    g = f"{group}, " if group else ""
    by = f"PARTITION BY {group}" if group else ""
    using = f"USING ({group})" if group else "ON true"
    also = f" AND a.{group} = b.{group}" if group else ""
    a_group = f"a.{group}, " if group else ""
    return f"""
ranks AS (
  SELECT {g}y, p, rank() OVER (w ORDER BY p) + (count(*) OVER (PARTITION BY {g}p) - 1) / 2.0::DOUBLE AS r
  FROM s WINDOW w AS ({by})
),
auc AS (
  SELECT {g}(sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE)
         / (sum(y)::DOUBLE * (count(*) - sum(y))) AS roc_auc
  FROM ranks GROUP BY ALL
),
cells AS (SELECT {g}p, sum(y)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM s GROUP BY ALL),
cuts AS (
  SELECT {a_group}a.p, any_value(a.pos) AS pos, sum(b.pos) AS tp, sum(b.n) AS hits
  FROM cells a JOIN cells b ON b.p >= a.p{also} GROUP BY ALL
),
ap AS (SELECT {g}sum(pos * tp / hits) / sum(pos) AS pr_auc FROM cuts GROUP BY ALL),
plain AS (
  SELECT {g}avg(CASE WHEN (p >= 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
         coalesce(count(*) FILTER (p >= 0.5 AND y = 1)::DOUBLE / nullif(count(*) FILTER (p >= 0.5), 0), 0) AS precision,
         coalesce(count(*) FILTER (p >= 0.5 AND y = 1)::DOUBLE / nullif(count(*) FILTER (y = 1), 0), 0) AS recall,
         avg((p - y) * (p - y)) AS brier_score
  FROM s GROUP BY ALL
),
curve AS (
  SELECT {g}CAST(greatest(ceil(p * 10), 1) AS INTEGER) AS bin, avg(p) AS mean_prediction,
         avg(y::DOUBLE) AS positive_share, count(*) AS rows
  FROM s GROUP BY ALL
),
ece AS (
  SELECT {g}sum(abs(mean_prediction - positive_share) * rows) / sum(rows) AS calibration_error
  FROM curve GROUP BY ALL
),
evaluation AS (
  SELECT {g}{_r('roc_auc', 'roc_auc')}, {_r('pr_auc', 'pr_auc')}, {_r('accuracy', 'accuracy')},
         {_r('precision', 'precision')}, {_r('recall', 'recall')},
         {_r('coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)', 'f1')},
         {_r('brier_score', 'brier_score')}, {_r('calibration_error', 'calibration_error')}, 0.5::DOUBLE AS threshold
  FROM auc JOIN ap {using} JOIN plain {using} JOIN ece {using}
)"""


def _whole(select: str) -> str:
    return with_views(SCORED, _S, _metrics(""), query=select)


ORACLES = {
    "roc_auc": _whole(f"SELECT {_r('roc_auc', 'roc_auc')} FROM auc"),
    "average_precision": _whole(f"SELECT {_r('pr_auc', 'pr_auc')} FROM ap"),
    "classification_metrics": _whole("SELECT accuracy, precision, recall, f1 FROM evaluation"),
    "brier": _whole(f"SELECT {_r('brier_score', 'brier_score')} FROM plain"),
    "calibration_curve": _whole(
        f"SELECT bin, {_r('mean_prediction', 'mean_prediction')}, {_r('positive_share', 'positive_share')}, rows FROM curve"
    ),
    "calibration_error": _whole(f"SELECT {_r('calibration_error', 'calibration_error')} FROM ece"),
    "max_f1_threshold": _whole(
        f"""SELECT p AS threshold, {_r('2 * tp / (hits + (SELECT sum(y) FROM s))', 'f1')}
FROM cuts ORDER BY 2 * tp / (hits + (SELECT sum(y) FROM s)) DESC, p DESC LIMIT 1"""
    ),
    "evaluation_row": _whole("SELECT * FROM evaluation"),
    "score_checks": with_views(
        SCORED, _S,
        query="""SELECT count(*) AS rows, count(*) FILTER (p IS NULL) AS missing,
       count(*) FILTER (isnan(p) OR isinf(p)) AS not_finite,
       count(*) FILTER (NOT isnan(p) AND (p < 0 OR p > 1)) AS out_of_range FROM s""",
    ),
    "model_comparison": with_views(
        SCORED, _S, _metrics("model"),
        query="SELECT * EXCLUDE (model), model::INTEGER AS model FROM evaluation",
    ),
    "rule_classifier": with_views(
        CUSTOMERS,
        query="""
SELECT contract_length, CASE WHEN age > 50 OR support_calls >= 6 OR payment_delay > 20 OR total_spend <= 500
                                  OR contract_length = 'Monthly' THEN 1 ELSE 0 END AS predicted, count(*) AS rows
FROM customers GROUP BY ALL""",
    ),
    "confusion_matrix": with_views(
        CUSTOMERS,
        query="""
SELECT churn AS actual, count(*) FILTER (NOT hit) AS predicted_0, count(*) FILTER (hit) AS predicted_1
FROM (SELECT *, age > 50 OR support_calls >= 6 OR payment_delay > 20 OR total_spend <= 500
             OR contract_length = 'Monthly' AS hit FROM customers) GROUP BY churn""",
    ),
}
