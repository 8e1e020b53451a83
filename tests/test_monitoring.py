"""Cohorts, drift and the report."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.operators import cohorts as C
from cohorta.operators import drift as D
from cohorta.operators import scores as S
from cohorta.plans import views as V
from cohorta.plans.monitoring import monitor_datasets, monitor_files, record_report, with_contract_time
from cohorta.plans.report import build_report
from cohorta.sources import events
from cohorta.sources.monthly import write_monthly
from tests.conftest import SF, cohort

T = "reference_date"
JAN, FEB = ["2026-01-05", "2026-01-15", "2026-01-25"], ["2026-02-05", "2026-02-15"]


@pytest.fixture()
def reference(spark):
    return cohort(spark, JAN, [0.2, 0.7, 0.8], [0, 1, 1], [0, 1, 1])


@pytest.fixture()
def analysis(spark):
    return cohort(spark, FEB, [0.35, 0.75], [0, 1])


def with_latency(df, latency=10.0):
    return df.withColumn("latency_ms", F.lit(latency))


def test_report_without_drift(reference, analysis):
    rows = build_report(reference, analysis, CHURN, source_analysis="batch", drift=False).collect()
    assert [r["period"] for r in rows] == ["reference", "analysis"]
    assert sum(r["prediction_count"] for r in rows) == 5
    first = rows[0]
    assert (first["realized_precision"], first["realized_recall"], first["realized_roc_auc"]) == (1, 1, 1)
    assert first["observed_positive_rate"] == 0.6667 and rows[1]["observed_positive_rate"] is None
    assert first[T] == dt.datetime(2026, 1, 1)
    assert "api_request_count" not in rows[0].asDict()


def test_report_with_drift_and_errors(spark, reference, analysis):
    errors = with_latency(cohort(spark, ["2026-02-20"], [0.5], [0]).drop("predicted_probability", "predicted_class"), 95.0)
    report = build_report(reference, with_latency(analysis), CHURN, errors=errors, calibrate="never")
    rows = {r["period"]: r for r in report.collect()}
    assert rows["reference"]["cbpe_precision"] == 0.75
    analysis_row = rows["analysis"]
    assert analysis_row["api_request_count"] == 3 and analysis_row["api_error_rate"] == 0.3333
    assert analysis_row["prediction_latency_p50_ms"] == 10 and analysis_row["api_error_latency_p95_ms"] == 95
    for name in ("cbpe_precision", "reconstruction_drift_alert_count", "univariate_drift_alert_count"):
        assert analysis_row[name] is not None
    assert analysis_row["univariate_drift_alert_count"] > 0 and rows["reference"]["univariate_drift_alert_count"] == 0


def test_calibration_only_where_it_helps(spark):
    """Version 1 scores are rates already, version 2 scores are far too high."""
    rng = random.Random(6)
    rows = []
    for version in (1, 2):
        for i in range(3000):
            p = rng.randrange(1, 20) / 20
            day = dt.datetime(2026, 1, 1 + i % 28)
            rows.append((version, p, int(rng.random() < (p if version == 1 else p / 4)), day))
    df = spark.createDataFrame(rows, "model_version int, predicted_probability double, y int, reference_date timestamp_ntz")
    maps = S.fit_calibrators(df, "y", "reference_date", "auto")
    assert 2 in {r[0] for r in maps.lines.select("model_version").distinct().collect()}
    always = S.fit_calibrators(df, "y", "reference_date", "always")
    assert {r[0] for r in always.lines.select("model_version").distinct().collect()} == {1, 2}
    mapped = S.apply_calibrators(df, maps).where("model_version = 2")
    assert mapped.count() == 3000
    mean, rate = mapped.agg(F.avg("predicted_probability"), F.avg("y")).first()
    assert mean == pytest.approx(rate)


def test_overlapping_periods_disable_drift(spark, reference):
    same_month = cohort(spark, ["2026-01-30", "2026-02-02"], [0.3, 0.6], [0, 1])
    report = build_report(reference, same_month, CHURN, source_analysis="batch")
    assert not [c for c in report.columns if "cbpe" in c or "alert" in c]


def test_errors_can_make_periods_overlap(spark, reference, analysis):
    early = with_latency(cohort(spark, ["2026-01-20"], [0.5], [0]).drop("predicted_probability", "predicted_class"))
    report = build_report(reference, with_latency(analysis), CHURN, errors=early)
    assert not [c for c in report.columns if "alert" in c]
    alone = [r for r in report.collect() if r["source"] is None]
    assert len(alone) == 1 and alone[0]["api_error_rate"] == 1


def test_bad_error_payloads_are_set_aside(spark, reference, analysis):
    errors = with_latency(
        cohort(spark, ["2026-02-20", "2026-02-21"], [0.5, 0.5], [0, 0]).drop("predicted_probability", "predicted_class")
    ).withColumn("age", F.when(F.col(T) < F.lit("2026-02-21").cast("timestamp_ntz"), F.lit("old")).otherwise(F.col("age").cast("string")))
    good, bad = C.quarantine_errors(errors, CHURN)
    assert (good.count(), bad.count()) == (1, 1)
    # both failed requests count, whatever the drift figures can use
    for drift in (True, False):
        rows = build_report(reference, with_latency(analysis), CHURN, errors=errors, drift=drift).collect()
        assert [r["api_request_count"] for r in rows if r["period"] == "analysis"] == [4]
        assert [r["api_error_rate"] for r in rows if r["period"] == "analysis"] == [0.5]


def test_version_selection(spark, reference, analysis):
    both = analysis.unionByName(analysis.withColumn("model_version", F.lit(9)))
    rows = build_report(reference, both, CHURN, source_analysis="batch", drift=False).collect()
    assert {r["model_version"] for r in rows} == {5}
    with pytest.raises(ValueError, match="share no model version"):
        build_report(reference, both, CHURN, source_analysis="batch", drift=False, model_version=9)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda d: d.withColumn("predicted_probability", F.lit(1.2)), "probability"),
        (lambda d: d.withColumn("predicted_class", F.lit(2)), "class"),
        (lambda d: d.drop("model_version"), "model_version"),
        (lambda d: d.withColumn("churn", F.lit(1)), "both target classes"),
        (lambda d: d.withColumn("churn", F.when(F.col("churn") == 1, 1)), "missing label"),
        (lambda d: d.drop("age"), "age"),
        (lambda d: d.withColumn("age", F.lit(5)), "age out_of_range"),
    ],
)
def test_invalid_reference_cohorts(reference, analysis, change, message):
    with pytest.raises(ValueError, match=message):
        build_report(change(reference), analysis, CHURN, source_analysis="batch")


def test_unknown_sources(reference, analysis):
    with pytest.raises(ValueError):
        build_report(reference, analysis, CHURN, source_analysis="stream")


def test_operational_summary(spark):
    schema = f"period string, model_version int, {T} timestamp_ntz, latency_ms double"
    day = [dt.datetime(2026, 2, 1), dt.datetime(2026, 2, 2)]
    ok = spark.createDataFrame([("analysis", 1, day[0], 10.0), ("analysis", 1, day[1], 30.0)], schema)
    failed = spark.createDataFrame([("analysis", 1, day[0], 95.0)], schema)
    rows = C.operational_summary(ok, failed, T).orderBy(T).collect()
    assert [r["api_request_count"] for r in rows] == [2, 1]
    assert [r["api_error_rate"] for r in rows] == [0.5, 0.0]
    assert rows[1]["api_error_latency_p50_ms"] is None


def test_missing_latency_still_counts(spark):
    schema = f"period string, model_version int, {T} timestamp_ntz, latency_ms double"
    day = dt.datetime(2026, 2, 1)
    ok = spark.createDataFrame([("analysis", 1, day, v) for v in (None, None, 10.0, 20.0)], schema)
    row = C.operational_summary(ok, ok.limit(0), T).first()
    assert row["api_request_count"] == 4 and row["prediction_latency_p50_ms"] == 15


def test_merged_outcome_summaries(spark):
    key = f"period string, model_version int, {T} timestamp_ntz"
    day = [dt.datetime(2026, 2, 1), dt.datetime(2026, 2, 2)]
    ok = spark.createDataFrame([("analysis", 1, day[0], 3), ("analysis", None, day[1], 1)], key + ", api_success_count int")
    failed = spark.createDataFrame([("analysis", None, day[1], 1)], key + ", api_error_count int")
    rows = C.merge_latency_summaries(ok, failed, T).orderBy(T).collect()
    assert [(r["api_request_count"], r["api_error_rate"]) for r in rows] == [(3, 0.0), (2, 0.5)]


def brute_js(p_counts, q_counts):
    keys = set(p_counts) | set(q_counts)
    p = np.array([p_counts.get(k, 0) for k in keys]) / sum(p_counts.values())
    q = np.array([q_counts.get(k, 0) for k in keys]) / sum(q_counts.values())
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum()
        right = np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt((left + right) / 2))


def test_categorical_distance(spark):
    def rows(words, day, period="reference"):
        return [(1, period, dt.datetime.fromisoformat(day), w) for w in words]

    schema = f"model_version int, period string, {T} timestamp_ntz, word string"
    new = rows("abbddd", "2026-02-01", "analysis") + [(1, "analysis", dt.datetime(2026, 2, 1), None)]
    found = D.categorical_distances(spark.createDataFrame(rows("aaabbc", "2026-01-01") + new, schema), ["word"], T)
    distances = {r["period"]: r["distance"] for r in found.collect()}
    assert distances["reference"] == pytest.approx(0, abs=1e-7)
    assert distances["analysis"] == pytest.approx(brute_js({"a": 3, "b": 2, "c": 1}, {"a": 1, "b": 2, "d": 3}))


def doane_edges(x):
    n, spread = len(x), x.max() - x.min()
    skew_error = np.sqrt(6.0 * (n - 2) / ((n + 1.0) * (n + 3)))
    skew = np.mean(((x - x.mean()) / x.std()) ** 3)
    width = spread / (1 + np.log2(n) + np.log2(1 + abs(skew) / skew_error))
    return np.linspace(x.min(), x.max(), int(np.ceil(spread / width)) + 1)


def test_continuous_distance_equals_histograms(spark):
    rng = np.random.default_rng(4)
    old, new = rng.gamma(2.0, 1.0, 800), rng.gamma(2.5, 1.2, 300)
    schema = f"model_version int, period string, {T} timestamp_ntz, v double"

    def frame(values, day, period):
        return spark.createDataFrame([(1, period, dt.datetime.fromisoformat(day), float(v)) for v in values], schema)

    edges = doane_edges(old)
    assert list(edges) == pytest.approx(list(np.histogram_bin_edges(old, bins="doane")))
    p = np.histogram(old, edges)[0]
    q = np.append(np.histogram(new, edges)[0], 0)
    q[-1] = len(new) - q.sum()
    want = brute_js(dict(enumerate(np.append(p, 0))), dict(enumerate(q)))
    cohorts = frame(old, "2026-01-01", "reference").unionByName(frame(new, "2026-02-01", "analysis"))
    found = {r["period"]: r["distance"] for r in D.continuous_distances(cohorts, ["v"], T).collect()}
    assert found["analysis"] == pytest.approx(want) and found["reference"] == pytest.approx(0, abs=1e-7)


def test_alert_counts_treat_missing_as_quiet(spark):
    schema = f"period string, model_version int, {T} timestamp_ntz, feature string, alert boolean"
    day = dt.datetime(2026, 2, 1)
    df = spark.createDataFrame([("analysis", 1, day, f, a) for f, a in (("a", True), ("b", None), ("c", False), ("d", True))], schema)
    assert D.alert_counts(df, T, "x").first()["x_alert_count"] == 2


def test_reconstruction_fills_gaps_with_medians_and_modes(spark):
    schema = f"period string, model_version int, {T} timestamp_ntz, a double, b double, w string"
    day = dt.datetime(2026, 1, 1)
    full = [("reference", 1, day, float(i), float(i * i % 7), "xy"[i % 3 == 0]) for i in range(30)]
    gap = [("analysis", 1, dt.datetime(2026, 2, 1), None, 3.0, None)]
    same = [("analysis", 1, dt.datetime(2026, 2, 1), 14.5, 3.0, "x")]

    def error(rows):
        df = spark.createDataFrame(full + rows, schema)
        model = D.ReconstructionDrift(["a", "b", "w"], T).fit(df.where("period = 'reference'"))
        return model.calculate(df).where("period = 'analysis'").first()["reconstruction_error"]

    assert error(gap) == pytest.approx(error(same))


@pytest.mark.parametrize("impute", [True, False])
def test_reconstruction_equals_numpy(spark, impute):
    """Standardise, project on the axes that explain 65 percent, mean residual per month."""
    reference, analysis = V.scored_cohorts(spark, SF)
    before = C.prepare_cohort(reference, "reference", "batch", V.RETURNS, require_target=True, require_features=True)
    after = C.prepare_cohort(analysis, "analysis", "batch", V.RETURNS, require_features=True)
    model = D.ReconstructionDrift(V.RETURNS.feature_columns, T, impute=impute).fit(before)
    got = {
        (r["period"], r["model_version"], r[T]): (r["reconstruction_error"], r["alert"])
        for r in model.calculate(before.unionByName(after)).collect()
    }
    names = list(V.RETURNS.feature_columns)
    whole = before.unionByName(after).select("period", "model_version", T, *names).toPandas()
    for version in (1, 2):
        part = whole[whole.model_version == version].copy()
        ref = part[part.period == "reference"]
        counts = ref.line_status.value_counts()
        part["line_status"] = part.line_status.map(counts).fillna(0).astype(float)
        x = part[names].to_numpy(float)
        r = x[(part.period == "reference").to_numpy()]
        deviation = r.std(axis=0)
        deviation[deviation == 0] = 1
        z, zr = (x - r.mean(axis=0)) / deviation, (r - r.mean(axis=0)) / deviation
        strength, axes = np.linalg.eigh(np.cov(zr.T, bias=True))
        order = strength.argsort()[::-1]
        kept = int(np.searchsorted(np.cumsum(strength[order]) / strength.sum(), 0.65, side="right")) + 1
        basis = axes[:, order[:kept]]
        part["error"] = np.sqrt(((z - z @ basis @ basis.T) ** 2).sum(axis=1))
        months = part.groupby(["period", T])["error"].mean()
        spread = months["reference"]
        low, high = spread.mean() - 3 * spread.std(ddof=0), spread.mean() + 3 * spread.std(ddof=0)
        for (period, month), value in months.items():
            error, alert = got[(period, version, month.to_pydatetime())]
            assert error == pytest.approx(value, abs=1e-9)
            assert alert == bool(value < max(low, 0) or value > high)


def test_file_front_end(spark, folder, reference, analysis):
    reference.write.csv(f"{folder}/reference", header=True)
    analysis.write.csv(f"{folder}/analysis", header=True)
    with pytest.raises(ValueError):
        monitor_files(spark, f"{folder}/reference", CHURN)
    with pytest.raises(ValueError):
        monitor_files(spark, f"{folder}/reference", CHURN, analysis_csv="a", error_log="e")
    report = monitor_files(
        spark, f"{folder}/reference", CHURN, analysis_csv=f"{folder}/analysis", output_folder=folder
    )
    assert report.count() == 2
    written = spark.read.csv(f"{folder}/monitoring_summary_batch", header=True).collect()
    assert [r["period"] for r in written] == ["reference", "analysis"]
    assert written[0]["realized_recall"] == "1.0000" and written[1]["realized_recall"] is None


def test_log_front_end(spark, folder, reference, analysis):
    reference.write.csv(f"{folder}/reference", header=True)
    about = {"request_id": F.lit("r"), "model_name": F.lit("m"), "latency_ms": F.lit(12.5)}
    events.write_events(events.prediction_records(analysis.withColumns(about), CHURN), f"{folder}/ok")
    failed = analysis.withColumns(about | {"error_type": F.lit("E"), "error_message": F.lit("x")})
    events.write_events(events.error_records(failed.limit(1), CHURN), f"{folder}/failed")
    rows = monitor_files(
        spark, f"{folder}/reference", CHURN, prediction_log=f"{folder}/ok", error_log=f"{folder}/failed"
    ).collect()
    last = next(r for r in rows if r["period"] == "analysis")
    assert last["api_request_count"] == 3 and last["prediction_latency_p95_ms"] == 12.5


def test_dataset_front_end(spark, folder, reference, analysis):
    write_monthly(reference, f"{folder}/reference", T)
    write_monthly(analysis.withColumnRenamed(T, "scored_at"), f"{folder}/analysis", "scored_at")
    renamed = reference.withColumnRenamed(T, "scored_at")
    assert T in with_contract_time(renamed, CHURN, "scored_at").columns
    write_monthly(renamed, f"{folder}/renamed", "scored_at")
    report = monitor_datasets(spark, f"{folder}/renamed", f"{folder}/analysis", CHURN, "scored_at")
    assert report.count() == 2
    with pytest.raises(ValueError):
        monitor_datasets(spark, f"{folder}/reference", None, CHURN)
    record_report(report, folder, CHURN, "run", {"model_version": "5"})
    kept = spark.read.json(f"{folder}/monitoring_runs").first()
    assert kept["experiment"] == "churn-monitoring" and kept["tags"]["model_version"] == "5"


def test_report_is_independent_of_partitioning(spark):
    reference, analysis = V.scored_cohorts(spark, SF)

    def report(partitions):
        return build_report(
            reference.repartition(partitions), analysis.repartition(partitions), V.RETURNS, source_analysis="batch"
        ).collect()

    assert report(1) == report(13)


def test_second_contract_end_to_end(spark):
    reference, analysis, errors = V.api_cohorts(spark, SF)
    rows = build_report(reference, analysis, V.REQUESTS, errors=errors, period="day").collect()
    assert {r["period"] for r in rows} == {"reference", "analysis"}
    assert all(r["api_request_count"] for r in rows if r["period"] == "analysis")


def test_versions_are_a_table(spark, reference, analysis):
    """A cohort may have any number of versions; only common ones are reported."""
    many = reference.crossJoin(spark.range(12_000).select(F.col("id").cast("int").alias("v")))
    shifted = many.withColumn("model_version", F.col("v") + F.lit(100)).drop("v")
    both = reference.unionByName(shifted)
    checked = C.check_cohort(both, "reference", "batch", CHURN, require_target=True)
    assert checked.versions.count() == 12_000 + reference.select("model_version").distinct().count()
    report = build_report(both, analysis, CHURN, source_analysis="batch", drift=False)
    alone = build_report(reference, analysis, CHURN, source_analysis="batch", drift=False)
    assert report.collect() == alone.collect()


def test_figures_from_counted_predictions_equal_those_from_rows(spark):
    rows = V.scored_cohorts(spark, SF)[0].withColumns({C.SOURCE: F.lit("batch"), C.PERIOD: F.lit("reference")})
    cells = C.prediction_cells(rows, V.RETURNS)
    figures = (
        lambda df, n: C.base_summary(df, "reference_date", n),
        lambda df, n: C.realized_metrics(df, V.RETURNS, rows=n),
        lambda df, n: D.estimated_performance(df, "reference_date", rows=n),
    )
    for figure in figures:
        wanted, found = ({tuple(r)[:4]: tuple(r)[4:] for r in figure(*given).collect()} for given in ((rows, None), (cells, C.ROWS)))
        assert wanted.keys() == found.keys()
        for key, values in wanted.items():
            assert found[key] == pytest.approx(values, nan_ok=True)
