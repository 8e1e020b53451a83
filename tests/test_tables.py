"""Samples, splits, assignments, profiles, promotion."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.operators import profile as P
from cohorta.operators import promotion as R
from cohorta.operators import sampling as S
from cohorta.learning.settings import Fitting, JobPlan, Release
from cohorta.plans.training import quality_score


def numbers(spark, count, partitions=4):
    return spark.range(count).withColumnRenamed("id", "x").repartition(partitions)


@pytest.mark.parametrize("values", [["A", "B", "C"], list(range(7)), ["only"]])
def test_balanced_groups_differ_by_at_most_one(spark, values):
    counts = [r["count"] for r in S.assign_balanced(numbers(spark, 100), values, "g", "x").groupBy("g").count().collect()]
    assert sum(counts) == 100 and len(counts) == len(values) and max(counts) - min(counts) <= 1


def test_more_values_than_rows(spark):
    rows = S.assign_balanced(numbers(spark, 3), list("abcdef"), "g", "x").collect()
    assert len(rows) == 3 and len({r["g"] for r in rows}) == 3


def test_assignment_is_reproducible_and_seeded(spark):
    def groups(partitions, seed):
        df = S.assign_balanced(numbers(spark, 42, partitions), [1, 2, 3], "g", "x", seed)
        return {r["x"]: r["g"] for r in df.collect()}

    assert groups(1, 42) == groups(9, 42) != groups(4, 7)


def test_sample_is_reproducible(spark):
    def sample(partitions):
        return sorted(r["x"] for r in S.seeded_sample(numbers(spark, 200, partitions), "x", 17, 5).collect())

    assert sample(1) == sample(8) and len(sample(3)) == 17
    assert S.seeded_sample(numbers(spark, 5), "x", 17).count() == 5


def test_stratified_split_shares(spark):
    df = numbers(spark, 200).withColumn("y", (F.col("x") % 10 == 0).cast("int"))
    got = {(r["y"], r["split"]): r["count"] for r in S.stratified_split(df, "x", "y").groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 54, (0, "train"): 126, (1, "test"): 6, (1, "train"): 14}


@pytest.mark.parametrize(
    ("start", "end", "step", "want"),
    [
        ("2026-01-01", "2026-03-01", "1 month", ["2026-01-01", "2026-02-01", "2026-03-01"]),
        ("2026-01-15", "2026-03-10", "1 month", ["2026-02-01", "2026-03-01"]),
        ("2026-01-02", "2026-01-20", "1 month", []),
        ("2026-01-30", "2026-02-01", "1 day", ["2026-01-30", "2026-01-31", "2026-02-01"]),
    ],
)
def test_date_spine(spark, start, end, step, want):
    got = [r[0] for r in S.date_spine(spark, start, end, step).collect()]
    assert got == [dt.datetime.fromisoformat(d) for d in want]


def test_numeric_profile(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=201)
    df = spark.createDataFrame([(float(v), "a") for v in values] + [(None, "b")], "v double, w string")
    row = P.numeric_profile(df).first()
    assert row["feature"] == "v" and row["count"] == 201
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert row["std"] == pytest.approx(values.std(ddof=1))


def test_string_profile_breaks_ties_by_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "w string")
    row = P.string_profile(df, ["w"]).first()
    assert (row["count"], row["unique"], row["top"], row["freq"]) == (4, 2, "a", 2)


def test_quantile_bins_merge_repeated_borders(spark):
    df = spark.createDataFrame([(0.0, 0)] * 8 + [(1.0, 1), (2.0, 1)], "v double, y int")
    rows = P.incidence_quantiles(df, "v", "y", 4).orderBy("bin").collect()
    # the borders are 0, 0, 0, 0 and 2: one bin
    assert [(r["rows"], r["incidence"], r["bin_high"]) for r in rows] == [(10, 0.2, 2.0)]
    constant = P.incidence_quantiles(df.withColumn("v", F.lit(3.0)), "v", "y", 4).collect()
    assert [(r["rows"], r["bin_high"]) for r in constant] == [(10, 3.0)]


def test_fixed_bins_are_right_closed(spark):
    df = spark.createDataFrame([(100.0, 1), (200.0, 0), (200.5, 1), (99.0, 1), (1001.0, 1)], "v double, y int")
    rows = {r["bin_high"]: r["rows"] for r in P.incidence_fixed_bins(df, "v", "y", 100, 1000, 100).collect()}
    assert rows == {200.0: 2, 300.0: 1}


def test_histogram_equals_numpy(spark):
    values = [0.0, 0.05, 0.1, 0.55, 0.99, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["bin"]: r["rows"] for r in P.histogram(df, "v", 0, 1, 10).collect()}
    want = np.histogram(values, 10, (0, 1))[0]
    assert got == {i: n for i, n in enumerate(want) if n}


EQUAL = dict.fromkeys(("roc_auc", "pr_auc", "f1", "brier_score", "calibration_error"), 0.2)
CANDIDATE = {"roc_auc": 0.95, "pr_auc": 0.9, "f1": 0.8, "brier_score": 0.1, "calibration_error": 0.05}
CHAMPION = {"roc_auc": 0.9, "pr_auc": 0.9, "f1": 0.8, "brier_score": 0.2, "calibration_error": 0.1}


def long(spark, **runs):
    rows = [(run, m, v) for run, metrics in runs.items() for m, v in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, metric string, value double")


def decide(spark, candidate, champion, min_delta, weights=EQUAL):
    table = long(spark, new=candidate, **({"old": champion} if champion is not None else {}))
    pairs = spark.createDataFrame([("new", "old" if champion is not None else None)], "run_id string, champion_run_id string")
    return R.promotion_decisions(pairs, R.weighted_scores(table, weights), min_delta).first()


def test_weighted_promotion(spark):
    row = decide(spark, CANDIDATE, CHAMPION, 0.01)
    assert row["candidate_score"] == pytest.approx(0.90) and row["champion_score"] == pytest.approx(0.86)
    assert row["score_delta"] == pytest.approx(0.04) and row["promote"]


@pytest.mark.parametrize(("min_delta", "promoted"), [(0.1, False), (0.099, True)])
def test_gain_must_exceed_the_delta(spark, min_delta, promoted):
    row = decide(spark, {"f1": 0.8}, {"f1": 0.7}, min_delta, {"f1": 1.0})
    assert row["promote"] is promoted


def test_first_and_incomparable_champions(spark):
    assert decide(spark, CANDIDATE, None, 0.01)["reason"] == R.FIRST_CHAMPION
    broken = decide(spark, CANDIDATE, {"f1": 0.5}, 0.01)
    assert not broken["promote"] and broken["reason"] == R.NOT_COMPARABLE and broken["champion_score"] is None
    assert not decide(spark, {"f1": 0.9}, CHAMPION, 0.0)["promote"]


def test_score_checks(spark):
    equal, f1 = (JobPlan(Fitting("nb"), release=Release(weights=w)) for w in (EQUAL, {"f1": 1.0}))
    assert quality_score(spark, CANDIDATE, equal) == pytest.approx(0.9)
    assert quality_score(spark, {"roc_auc": 0.5}, f1) is None
    assert quality_score(spark, {"f1": 1.2}, f1) is None
    assert quality_score(spark, {"f1": None}, f1) is None
    for weights in ({}, {"f1": -1.0}, {"f1": 0.0}, {"f1": float("nan")}):
        with pytest.raises(ValueError):
            R.check_weights(weights)
    row = R.weighted_scores(long(spark, r={"f1": 1.2}), {"f1": 1.0}).first()
    assert row["score"] is None and row["invalid"] == 1
