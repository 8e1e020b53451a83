"""Metrics, ranks and running totals against goldens and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.operators import metrics as M
from cohorta.operators.prefix import quantile_cuts, running_totals
from cohorta.operators.ranks import column_percentiles, grouped_percentiles

SCHEMA = "y int, p double"


def frame(spark, ys, ps):
    return spark.createDataFrame(list(zip(ys, ps)), SCHEMA)


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    total, hits = sum(y for y, _ in rows), 0.0
    for cut in sorted({p for _, p in rows}, reverse=True):
        at = sum(1 for y, p in rows if p == cut and y == 1)
        tp = sum(1 for y, p in rows if p >= cut and y == 1)
        hits += at / total * tp / sum(1 for _, p in rows if p >= cut)
    return hits


def brute_f1(rows):
    best = (-1.0, -1.0)
    total = sum(y for y, _ in rows)
    for cut in {p for _, p in rows} | {0.0, 1.0}:
        tp = sum(1 for y, p in rows if p >= cut and y == 1)
        flagged = sum(1 for _, p in rows if p >= cut)
        best = max(best, (2 * tp / (flagged + total), cut))
    return best


def random_rows(count, seed, levels=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        p = rng.randrange(levels) / levels
        rows.append((int(rng.random() < 0.2 + 0.6 * p), p))
    return rows


def test_separable_scores(spark):
    row = M.evaluation_row(frame(spark, [0, 0, 1, 1], [0.1, 0.4, 0.6, 0.9]), "y", "p", 0.5).first()
    for name in ("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1"):
        assert row[name] == 1
    assert row["brier_score"] == pytest.approx(0.085)
    assert row["calibration_error"] == pytest.approx(0.25)


def test_threshold_is_inclusive_and_explicit(spark):
    row = M.classification_metrics(frame(spark, [0, 1, 1, 0], [0.2, 0.55, 0.8, 0.9]), "y", "p", 0.6).first()
    assert [row[n] for n in ("accuracy", "precision", "recall", "f1")] == [0.5] * 4
    hit = M.classification_metrics(frame(spark, [1], [0.6]), "y", "p", 0.6).first()
    assert hit["recall"] == 1


def test_best_threshold(spark):
    row = M.max_f1_threshold(frame(spark, [0, 0, 1, 1], [0.1, 0.4, 0.6, 0.7]), "y", "p").first()
    assert row["threshold"] == 0.6 and row["f1"] == 1
    one = M.max_f1_threshold(frame(spark, [1, 1], [0.1, 0.4]), "y", "p").first()
    assert one["threshold"] is None


def test_ties(spark):
    ys, ps = [0, 1, 1, 0, 1, 0], [0.2, 0.55, 0.8, 0.9, 0.55, 0.55]
    row = M.evaluation_row(frame(spark, ys, ps), "y", "p", 0.5).first()
    assert row["roc_auc"] == pytest.approx(0.555556, abs=1e-6)
    assert row["pr_auc"] == pytest.approx(0.566667, abs=1e-6)


def test_zero_division_is_zero_and_one_class_is_null(spark):
    row = M.evaluation_row(frame(spark, [0, 0], [0.1, 0.2]), "y", "p", 0.5).first()
    assert row["precision"] == 0 and row["recall"] == 0 and row["f1"] == 0
    assert row["roc_auc"] is None and row["pr_auc"] is None


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_metrics_equal_brute_force_for_any_partitioning(spark, partitions):
    rows = random_rows(600, seed=5)
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = M.evaluation_row(df, "y", "p", 0.5).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert got["pr_auc"] == pytest.approx(brute_ap(rows), abs=1e-12)
    best = M.max_f1_threshold(df, "y", "p").first()
    f1, cut = brute_f1(rows)
    assert (best["f1"], best["threshold"]) == (pytest.approx(f1), cut)


def test_one_group_with_most_rows(spark):
    """A hot group is spread over slices and still gives the exact value."""
    hot, cold = random_rows(3000, 1, levels=2000), random_rows(60, 2)
    rows = [("hot", *r) for r in hot] + [("cold", *r) for r in cold] + [(None, *r) for r in cold]
    df = spark.createDataFrame(rows, "k string, y int, p double")
    got = {r["k"]: r["roc_auc"] for r in M.roc_auc(df, "y", "p", ["k"]).collect()}
    assert got["hot"] == pytest.approx(brute_auc(hot), abs=1e-12)
    assert got["cold"] == got[None] == pytest.approx(brute_auc(cold), abs=1e-12)


def test_evaluation_row_agrees_with_single_metrics(spark):
    df = spark.createDataFrame(random_rows(500, 9, levels=97), SCHEMA)
    whole = M.evaluation_row(df, "y", "p", 0.4, 7).first()
    assert whole["brier_score"] == pytest.approx(M.brier(df, "y", "p").first()[0])
    assert whole["calibration_error"] == pytest.approx(M.calibration_error(df, "y", "p", 7).first()[0])
    plain = M.classification_metrics(df, "y", "p", 0.4).first()
    for name in ("accuracy", "precision", "recall", "f1"):
        assert whole[name] == pytest.approx(plain[name])


def test_input_checks(spark):
    df = frame(spark, [0, 1], [0.5, 1.5])
    with pytest.raises(ValueError):
        M.check_scores(df, "p")
    with pytest.raises(ValueError):
        M.evaluation_row(df, "y", "p", 1.5)
    with pytest.raises(ValueError):
        M.calibration_curve(df, "y", "p", 0)
    bad = M.invalid_scores(spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "p double"), "p").first()
    assert (bad["missing"], bad["not_finite"], bad["out_of_range"]) == (1, 1, 1)


def test_calibration_bins_are_right_closed(spark):
    df = frame(spark, [0, 0, 1], [0.0, 0.1, 0.11])
    assert {r["bin"]: r["rows"] for r in M.calibration_curve(df, "y", "p", 10).collect()} == {1: 2, 2: 1}


@pytest.mark.parametrize("cuts", [[], [10.0], [float(i) for i in range(0, 100, 7)], [-5.0, 1000.0]])
@pytest.mark.parametrize("descending", [True, False])
def test_cuts_only_balance_the_work(spark, cuts, descending):
    values = [(i, (i * 37) % 11) for i in range(100)]
    df = spark.createDataFrame(values, "o int, v int")
    got = {r["o"]: (r["running_v"], r["total_v"]) for r in running_totals(df, "o", ["v"], descending=descending, cuts=cuts).collect()}
    order = sorted(values, reverse=descending)
    total, want = sum(v for _, v in values), {}
    for i, (o, _) in enumerate(order):
        want[o] = (sum(v for _, v in order[: i + 1]), total)
    assert got == want


@pytest.mark.parametrize("partitions", [1, 5])
def test_percentiles_equal_linear_interpolation(spark, partitions):
    rng = random.Random(3)
    data = {"a": [rng.random() for _ in range(501)], "b": [1.0, 2.0, 4.0, 9.0], "c": [7.0]}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("d", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(partitions)
    got = {r["k"]: r for r in grouped_percentiles(df, "v", {"m": 0.5, "h": 0.95}, ["k"]).collect()}
    for k, vs in data.items():
        assert got[k]["m"] == pytest.approx(np.quantile(vs, 0.5))
        assert got[k]["h"] == pytest.approx(np.quantile(vs, 0.95))
    assert got["d"]["m"] is None


@pytest.mark.parametrize("partitions", [1, 6])
def test_column_percentiles_equal_numpy(spark, partitions):
    """Many ties, a third of the rows on one value, few rows, and an empty column."""
    rng = random.Random(11)
    wide = [rng.gauss(0, 5) for _ in range(2500)]
    tied = [2.0 if rng.random() < 0.34 else float(rng.randrange(6)) for _ in wide]
    rows = [(w, t, w if i < 4 else None, None, float("nan") if i % 2 else w) for i, (w, t) in enumerate(zip(wide, tied))]
    df = spark.createDataFrame(rows, "wide double, tied double, few double, none double, holes double").repartition(partitions)
    named = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = column_percentiles(df, ["wide", "tied", "few", "none", "holes"], named)
    for column, values in (("wide", wide), ("tied", tied), ("few", wide[:4]), ("holes", wide[::2])):
        assert [got[column][n] for n in named] == pytest.approx(list(np.quantile(values, list(named.values()))))
    assert set(got["none"].values()) == {None}


def test_ranking_never_sorts_rows_in_one_task(spark):
    """Only the few slice sums may share one task; rows are partitioned by slice."""
    df = spark.createDataFrame(random_rows(200, 4, levels=150), SCHEMA)
    counts = M.score_counts(df, "y", "p")
    plan = M.ranked(counts, quantile_cuts(df, "p"))._jdf.queryExecution().executedPlan().toString()
    single = plan.count("SinglePartition")
    assert single <= 1 and "hashpartitioning(_slice" in plan
