"""Preprocessing, classifiers, folds, calibration, tuning, training job, scoring."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.functions.features import rule_classifier
from cohorta.learning import calibration as K
from cohorta.learning.catalog import CATALOG, create_classifier
from cohorta.learning.classifiers import (
    BoostedStumps,
    GaussianBayes,
    LinearDiscriminant,
    MajorityClassifier,
    QuadraticDiscriminant,
)
from cohorta.learning.folds import fold_table, temporal_folds
from cohorta.learning.neighbours import NearestNeighbours
from cohorta.learning.pipelines import fit_pipeline
from cohorta.learning.settings import Fitting, JobPlan, Release, Search
from cohorta.learning.stages import Imputer, PopulationScaler
from cohorta.learning.tuning import draw, optimize
from cohorta.operators.metrics import roc_auc
from cohorta.plans import views as V
from cohorta.plans.scoring import (
    ForeignScorer,
    RuleScorer,
    load_scorer,
    observe_mean_probability,
    positive_class,
    sample_scoring_run,
    score_batch,
)
from cohorta.plans.training import train_model, training_job
from cohorta.sources.monthly import write_monthly
from cohorta.sources.registry import ModelRegistry
from cohorta.sources.runs import read_runs
from cohorta.sources.splits import create_split, with_split
from tests.conftest import SF

T = "reference_date"


@pytest.fixture(scope="module")
def sides(spark):
    rows = with_split(V.valid_customers(spark, "/root/testdata/sf0.01"), T, "2001-01-01").persist()
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def test_exact_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "b"), (9.0, "a"), (None, None)], "v double, w string")
    row = Imputer(["v", "w"]).fit(df).transform(df).where(F.col("w") == "a").collect()
    assert {r["v"] for r in row} == {2.0, 9.0, 3.0}
    mean = Imputer(["v"], "mean").fit(df).transform(df).agg(F.sum("v")).first()[0]
    assert mean == 20
    constant = Imputer(["v", "w"], "constant", "constant").fit(df).transform(df).collect()
    assert (constant[-1]["v"], constant[-1]["w"]) == (0.0, "missing_value")
    with pytest.raises(ValueError):
        Imputer(["v"], "guess")


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "v double, c double")
    rows = PopulationScaler(["v", "c"]).fit(df).transform(df).collect()
    assert [r["v"] for r in rows] == [-1, 1] and [r["c"] for r in rows] == [0, 0]


def points(spark, count=400, seed=2):
    rng = np.random.default_rng(seed)
    y = (rng.random(count) < 0.4).astype(int)
    x = rng.normal(size=(count, 3)) * np.where(y[:, None] == 1, [1.0, 0.6, 1.3], 1.0) + y[:, None] * np.array([1.0, -0.5, 0.2])
    rows = [(int(label), Vectors.dense(v)) for label, v in zip(y, x)]
    return x, y, spark.createDataFrame(rows, ["label", "features"]).repartition(5)


def probabilities(model, df):
    rows = model.transform(df).select("features", vector_to_array("probability")[1].alias("p")).collect()
    return np.array([r["features"].toArray() for r in rows]), np.array([r["p"] for r in rows])


def log_gauss(x, mean, cov):
    d = x - mean
    return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]


def sigmoid(v):
    return 1 / (1 + np.exp(-v))


def test_gaussian_bayes_equals_closed_form(spark):
    x, y, df = points(spark)
    at, got = probabilities(GaussianBayes(var_smoothing=1e-9).fit(df), df)
    parts = []
    for c in (0, 1):
        v = x[y == c].var(axis=0) + 1e-9 * x.var(axis=0).max()
        parts.append(log_gauss(at, x[y == c].mean(axis=0), np.diag(v)) + np.log((y == c).mean()))
    assert got == pytest.approx(sigmoid(parts[1] - parts[0]), abs=1e-9)


def test_discriminants_equal_closed_form(spark):
    x, y, df = points(spark)
    covs = [np.cov(x[y == c].T) for c in (0, 1)]
    counts = [(y == c).sum() for c in (0, 1)]
    pooled = sum(np.cov(x[y == c].T, bias=True) * (y == c).mean() for c in (0, 1))
    at, got = probabilities(LinearDiscriminant().fit(df), df)
    both = [log_gauss(at, x[y == c].mean(axis=0), pooled) + np.log(counts[c]) for c in (0, 1)]
    assert got == pytest.approx(sigmoid(both[1] - both[0]), abs=1e-8)
    at, got = probabilities(QuadraticDiscriminant(reg_param=0.1).fit(df), df)
    both = [log_gauss(at, x[y == c].mean(axis=0), 0.9 * covs[c] + 0.1 * np.eye(3)) + np.log(counts[c]) for c in (0, 1)]
    assert got == pytest.approx(sigmoid(both[1] - both[0]), abs=1e-8)


def test_boosted_stumps_and_majority(spark):
    x, y, df = points(spark, 300)
    model = BoostedStumps(n_estimators=4, write_every=2).fit(df)
    stumps = model.fitted()["stumps"]
    at, got = probabilities(model, df)
    total = sum(s["weight"] for s in stumps)
    votes = sum(s["weight"] * (2 * np.where(at[:, s["feature"]] <= s["cut"], s["low"], s["high"]) - 1) for s in stumps)
    assert got == pytest.approx(sigmoid(2 * votes / total))
    weights = np.ones(len(y))
    for s in stumps:
        wrong = np.where(x[:, s["feature"]] <= s["cut"], s["low"], s["high"]) != y
        error = weights[wrong].sum() / weights.sum()
        assert s["weight"] == pytest.approx(np.log((1 - error) / error))
        weights = weights * np.exp(s["weight"] * wrong)
    flat = MajorityClassifier().fit(df).transform(df)
    assert {r["prediction"] for r in flat.collect()} == {0.0}


def brute_votes(train, queries, k, weights):
    """Neighbour votes with the last place shared by its ties."""
    votes = []
    for q in queries:
        rows = sorted((float(np.sqrt(((np.array(x) - q) ** 2).sum())), y) for x, y in train)
        last = rows[k - 1][0]
        inside = [(d, y, 1.0) for d, y in rows if d < last]
        ties = [y for d, y in rows if d == last]
        inside += [(last, y, (k - len(inside)) / len(ties)) for y in ties]
        if weights == "distance":
            exact = [(y, w) for d, y, w in inside if d == 0]
            inside = [(0, y, w) for y, w in exact] if exact else [(d, y, w / d) for d, y, w in inside]
        votes.append(sum(w * y for _, y, w in inside) / sum(w for _, _, w in inside))
    return votes


@pytest.mark.parametrize(("weights", "limit"), [("uniform", 20_000), ("distance", 20_000), ("uniform", 7)])
def test_neighbours_equal_brute_force(spark, monkeypatch, weights, limit):
    """Also with a third of the points being one vector, and with blocks split very small."""
    monkeypatch.setattr("cohorta.learning.neighbours.POINTS_PER_TASK", limit)
    monkeypatch.setattr("cohorta.learning.neighbours.QUERIES_PER_TASK", limit)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(240, 3)) * [3, 1, 1], 1)
    x[:80] = [0.5, 0.0, 0.0]
    y = (rng.random(240) < sigmoid(x[:, 0])).astype(int)
    train = spark.createDataFrame([(int(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"])
    model = NearestNeighbours(n_neighbors=5, weights=weights).fit(train)
    asked = np.vstack([np.round(rng.normal(size=(60, 3)) * [4, 1, 1], 1), x[:100]])
    df = spark.createDataFrame([(i, Vectors.dense(a)) for i, a in enumerate(asked)], ["i", "features"]).repartition(7)
    rows = model.transform(df).select("i", vector_to_array("probability")[1].alias("p")).collect()
    got = {r["i"]: r["p"] for r in rows}
    want = brute_votes(list(zip(x.tolist(), y.tolist())), asked, 5, weights)
    assert len(rows) == len(asked) and len(model.fitted()["cuts"]) > 2
    assert [got[i] for i in range(len(asked))] == pytest.approx(want)


@pytest.mark.parametrize("alias", ["dc", "nb", "lr", "dt", "rf", "hgb", "lda", "qda", "knn"])
def test_catalogue_pipelines(spark, sides, alias):
    small = {"rf": {"n_estimators": 10, "max_depth": 5}, "dt": {"max_depth": 5}, "hgb": {"max_iter": 3}}.get(alias, {})
    train, test = sides
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3  # a session that has observed must still fit and score
    fitted, config = fit_pipeline(CHURN, alias, small, train)
    scored = fitted.score(test)
    assert scored.columns == [*test.columns, "predicted_probability"]
    low, high = scored.agg(F.min("predicted_probability"), F.max("predicted_probability")).first()
    assert 0 <= low <= high <= 1
    auc = roc_auc(scored, "churn", "predicted_probability").first()[0]
    # unscaled spend dominates the variance floor of the naive model
    assert auc == 0.5 if alias == "dc" else auc > (0.5 if alias == "nb" else 0.6)
    assert config["model_alias"] == alias
    assert fitted.names_out[-1] == "contract_length_Quarterly" and "gender_Female" in fitted.names_out


def test_unknown_and_overridden_classifiers():
    with pytest.raises(ValueError, match="known aliases"):
        create_classifier("nope", {}, "y", 10)
    assert CATALOG["lr"]["defaults"]["max_iter"] == 100


def test_unseen_categories_and_missing_values_score(spark, sides):
    train, test = sides
    fitted, _ = fit_pipeline(CHURN, "lr", {}, train)
    odd = test.limit(5).withColumns({"gender": F.lit("?"), "age": F.lit(None).cast("bigint")})
    assert fitted.score(odd).where(F.col("predicted_probability").isNull()).count() == 0


def days(spark, rows):
    start = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(start + dt.timedelta(days=d), y) for d, y in rows], f"{T} timestamp_ntz, target int")


@pytest.mark.parametrize(
    ("rows", "n"),
    [([(d, d % 2) for d in reversed(range(12))], 3), ([(d, y) for d in range(5) for y in (0, 1)], 2)],
)
def test_expanding_folds(spark, rows, n):
    df = days(spark, rows)
    folds = temporal_folds(df, "target", T, n)
    times = sorted({d for d, _ in rows})
    size = len(times) // (n + 1)
    start = dt.datetime(2026, 1, 1)
    assert len(folds) == n
    for k, fold in enumerate(folds):
        first = len(times) - (n - k) * size
        assert fold.start == start + dt.timedelta(days=times[first])
        assert fold.end == start + dt.timedelta(days=times[first + size - 1])
        train, valid = fold.split(df, T)
        assert train.agg(F.max(T)).first()[0] < valid.agg(F.min(T)).first()[0]
        for side in (train, valid):
            assert side.select("target").distinct().count() == 2
    assert fold_table(df, T, folds).where("role = 'train' and fold = 1").count() == folds[0].split(df, T)[0].count()


@pytest.mark.parametrize(
    ("rows", "n"),
    [([(0, 0), (1, 1)], 2), ([(d, 0) for d in range(12)], 3), ([(d, d % 2) for d in range(12)], 1)],
)
def test_fold_errors(spark, rows, n):
    with pytest.raises(ValueError):
        temporal_folds(days(spark, rows), "target", T, n)


def test_folds_need_times(spark):
    df = days(spark, [(d, d % 2) for d in range(12)])
    with pytest.raises(ValueError):
        temporal_folds(df.withColumn(T, F.lit("soon")), "target", T, 2)
    with pytest.raises(ValueError):
        temporal_folds(df.drop(T), "target", T, 2)


def scored_points(spark, count=500):
    rng = random.Random(8)
    rows = []
    for _ in range(count):
        s = round(rng.gauss(0, 2), 1)
        rows.append((int(rng.random() < sigmoid(0.7 * s + 0.3)), s))
    return rows, spark.createDataFrame(rows, "y int, s double")


def test_sigmoid_fit_minimises_smoothed_loss(spark):
    rows, df = scored_points(spark)
    model = K.fit_sigmoid(df, "y", "s")
    y, s = np.array(rows, float).T
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def gradient(a, b):
        gap = sigmoid(a * s + b) - target
        return np.array([(gap * s).sum(), gap.sum()])

    assert np.abs(gradient(float(model.coefficients[0]), model.intercept)).max() < 0.5


def pool_adjacent(rows):
    cells = {}
    for y, s in rows:
        n, total = cells.get(s, (0, 0))
        cells[s] = (n + 1, total + y)
    blocks = []
    for s in sorted(cells):
        n, total = cells[s]
        blocks.append([total, n, [s]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n, members = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2] + members]
    return {s: total / n for total, n, members in blocks for s in members}


def test_isotonic_equals_pool_adjacent_violators(spark):
    rows, df = scored_points(spark)
    model = K.fit_isotonic(df, "y", "s")
    want = pool_adjacent(rows)
    points_ = spark.createDataFrame([(s,) for s in [*want, -99.0, 99.0]], "score double")
    got = {r["score"]: r["calibrated"] for r in model.transform(points_).collect()}
    for s, value in want.items():
        assert got[s] == pytest.approx(value)
    assert got[-99.0] == pytest.approx(want[min(want)]) and got[99.0] == pytest.approx(want[max(want)])


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibrated_ensemble_is_the_fold_mean_and_survives_saving(spark, sides, folder, method):
    train, test = sides
    model, _ = K.fit_with_calibration(CHURN, "nb", {}, train, method, 2)
    assert len(model.members) == 2
    key = ["customerid"]
    whole = {r[0]: r[1] for r in model.score(test).select(*key, "predicted_probability").collect()}
    parts = [
        {r[0]: r[1] for r in m.score(test, "q").select(*key, "q").collect()} for m in model.members
    ]
    assert all(whole[k] == pytest.approx((parts[0][k] + parts[1][k]) / 2) for k in whole)
    assert all(0 <= p <= 1 for p in whole.values())
    K.save_model(model, f"{folder}/model", spark)
    again = K.load_model(f"{folder}/model", spark)
    assert {r[0]: r[1] for r in again.score(test).select(*key, "predicted_probability").collect()} == pytest.approx(whole)


def test_calibration_rules(spark, sides):
    train, _ = sides
    with pytest.raises(ValueError):
        K.fit_with_calibration(CHURN, "nb", {}, train, "beta")
    with pytest.raises(ValueError, match="probabilities"):
        K.fit_with_calibration(CHURN, "lsvc", {}, train, "none")


def test_draws_follow_the_space():
    for alias, entry in CATALOG.items():
        for name, value in draw(entry["space"], random.Random(alias)).items():
            part = entry["space"][name]
            assert value in part["choices"] if part["type"] == "categorical" else part["low"] <= value <= part["high"]
    assert draw(CATALOG["rf"]["space"], random.Random(1)) == draw(CATALOG["rf"]["space"], random.Random(1))
    with pytest.raises(ValueError):
        draw({"a": {"type": "other", "low": 0, "high": 1, "log": False}}, random.Random(1))


def test_search_is_repeatable(spark, sides):
    train, _ = sides

    def search(parallelism):
        tuning = Search(trials=2, folds=2, metric="pr_auc", parallelism=parallelism)
        return optimize(CHURN, JobPlan(Fitting("nb"), tuning), train)

    one, two = search(1), search(2)
    assert one.best_params == two.best_params and one.best_score == pytest.approx(two.best_score)
    with pytest.raises(ValueError, match="search space"):
        optimize(CHURN, JobPlan(Fitting("dc")), train)


def test_settings_are_checked():
    for bad in (
        lambda: Fitting(""), lambda: Fitting("lr", folds=1), lambda: Fitting("lr", bins=2.5), lambda: Fitting("lr", []),
        lambda: Search(trials=0), lambda: Search(metric="f1"), lambda: Search(parallelism=True),
        lambda: Release(weights={"other": 1.0}), lambda: Release(min_delta=-1.0), lambda: Release(min_delta=float("nan")),
        lambda: Release(weights={}), lambda: Release(weights={"f1": 0.0}), lambda: Release(weights={"f1": -1.0}),
    ):
        with pytest.raises(ValueError):
            bad()


def test_training_needs_both_classes(spark, sides):
    train, test = sides
    with pytest.raises(ValueError, match="both classes"):
        train_model(CHURN, JobPlan(Fitting("lr")), train.where("churn = 1"), test)


def test_training_job_end_to_end(spark, folder):
    """Write, split, train, register, promote, record, resolve and score."""
    write_monthly(V.valid_customers(spark, "/root/testdata/sf0.01"), f"{folder}/data", T)
    create_split(spark, f"{folder}/data", T, "1995-01-01", "2001-01-01", "2001-12-31", folder, "oot")
    store = f"{folder}/store"
    arguments = (spark, CHURN, JobPlan(Fitting("nb")), folder, "oot", store)
    first, record = training_job(*arguments, register_model=True, promote_model=True)
    assert record["model"]["version"] == 1 and record["lifecycle"]["promotion"]["decision"]["promote"]
    _, second = training_job(*arguments, register_model=True, promote_model=True)
    decision = second["lifecycle"]["promotion"]["decision"]
    assert not decision["promote"] and decision["score_delta"] == 0
    _, third = training_job(*arguments)
    assert third["model"]["version"] is None
    registry = ModelRegistry(spark, store)
    assert registry.version_of("churn-model", "champion") == 1
    assert registry.metrics_of("churn-model", "champion")["roc_auc"] == pytest.approx(first.metrics["roc_auc"])
    assert read_runs(spark, f"{store}/runs").count() == 3

    test = spark.read.parquet(f"{folder}/oot").where("split = 'test'").drop("split")
    want = {r[0]: r[1] for r in first.model.score(test).select("customerid", "predicted_probability").collect()}
    for chosen in ({"model_name": "churn-model", "alias": "champion"}, {"run_record": third}):
        scorer, threshold, version = load_scorer(spark, registry, CHURN, **chosen)
        scored = score_batch(test, CHURN, scorer, threshold, version).collect()
        assert {r["customerid"]: r["predicted_probability"] for r in scored} == pytest.approx(want)
        assert all(r["predicted_class"] == int(r["predicted_probability"] >= threshold) for r in scored)
        assert {r["model_version"] for r in scored} == {version}
    with pytest.raises(ValueError):
        load_scorer(spark, registry, CHURN, model_name="churn-model", run_record=third)
    with pytest.raises(ValueError):
        load_scorer(spark, registry, V.RETURNS, run_record=third)
    with pytest.raises(ValueError):
        load_scorer(spark, registry, CHURN)


class TwoColumns:
    def predict_proba(self, frame):
        p = frame["age"].to_numpy(float) / 200
        return np.column_stack([1 - p, p])


def test_foreign_models(spark, customers):
    scored = ForeignScorer(TwoColumns(), list(CHURN.feature_columns)).score(customers)
    assert all(r["predicted_probability"] == r["age"] / 200 for r in scored.collect())
    assert list(positive_class([0.1, 0.2], 2)) == [0.1, 0.2]
    with pytest.raises(ValueError):
        positive_class(np.zeros((2, 3)), 2)


def test_scores_keep_keys_and_observe_the_mean(spark, customers, folder):
    scored = score_batch(customers, CHURN, RuleScorer(rule_classifier), 0.5, 5)
    counted, watch = observe_mean_probability(scored)
    counted.write.parquet(f"{folder}/scored")
    mean = spark.read.parquet(f"{folder}/scored").agg(F.avg("predicted_probability")).first()[0]
    assert watch.get == {"rows": 12, "mean_probability": mean}
    assert sorted(r["customerid"] for r in scored.collect()) == list(range(1001, 1013))


def test_sample_run_is_a_numbered_file(spark, customers, folder):
    sample_scoring_run(
        customers, CHURN, RuleScorer(rule_classifier), 0.5, 1, "customerid", 4, 3, folder, 42, "2026-02-01"
    )
    rows = spark.read.csv(f"{folder}/0042_sample_predictions.csv", header=True).collect()
    assert len(rows) == 4 and rows[0][T].startswith("2026-02-01")
