"""CSV, JSON logs, monthly datasets, splits, run tables and registry."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.functions.scalars import utc_naive
from cohorta.plans.ingest import add_reference_dates, ingest_events, ingest_runs, malformed_folder, prepare_data
from cohorta.sources import delimited, events, monthly, splits
from cohorta.sources.registry import ModelRegistry
from cohorta.sources.runs import append_run, check_runs, read_runs
from tests.conftest import customer_rows

T = "reference_date"


def dated(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(d), v) for d, v in rows], f"{T} timestamp_ntz, value string"
    )


def values(df):
    return sorted(r["value"] for r in df.collect())


@pytest.fixture()
def dataset(spark, folder):
    path = f"{folder}/events"
    rows = [("2026-01-31", "1"), ("2026-02-01", "2"), ("2026-02-28", "3"),
            ("2026-02-28T23:59:59.999999", "4"), ("2026-03-01", "5")]
    monthly.write_monthly(dated(spark, rows), path, T)
    return path


def test_date_only_end_covers_the_day(spark, dataset):
    assert values(monthly.read_monthly(spark, dataset, T, "2026-02-01", "2026-02-28")) == ["2", "3", "4"]
    exact = monthly.read_monthly(spark, dataset, T, "2026-02-01", "2026-02-28 00:00:00")
    assert values(exact) == ["2", "3"]


def test_whole_dataset_and_bound_rules(spark, dataset):
    assert len(values(monthly.read_monthly(spark, dataset, T))) == 5
    with pytest.raises(ValueError):
        monthly.read_monthly(spark, dataset, T, start="2026-01-01")
    with pytest.raises(ValueError):
        monthly.read_monthly(spark, dataset, T, "2026-03-01", "2026-01-01")
    with pytest.raises(AnalysisException):
        monthly.read_monthly(spark, dataset + "-absent", T)


def test_only_touched_months_are_read(spark, dataset):
    found = monthly.read_monthly(spark, dataset, T, "2026-02-01", "2026-02-28")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "PushedFilters: [Is" in plan
    found.collect()
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "202602" in scan


def test_overwrite_replaces_only_present_months(spark, folder):
    path = f"{folder}/overwrite"
    monthly.write_monthly(dated(spark, [("2026-01-05", "old-january"), ("2026-02-05", "keep-february")]), path, T)
    monthly.write_monthly(dated(spark, [("2026-01-09", "new-january")]), path, T, overwrite_partitions=True)
    assert values(monthly.read_monthly(spark, path, T)) == ["keep-february", "new-january"]
    monthly.write_monthly(dated(spark, [("2026-01-10", "more")]), path, T)
    assert values(monthly.read_monthly(spark, path, T)) == ["keep-february", "more", "new-january"]


def test_empty_input_writes_nothing(spark, folder):
    monthly.write_monthly(dated(spark, []), f"{folder}/none", T)
    assert not os.path.exists(f"{folder}/none")


def test_writes_split_months_by_size_not_by_value(spark):
    """The write plan rebalances, so adaptive execution may use several tasks for a hot month."""
    rows = dated(spark, [("2026-01-05", "a")])
    plan = monthly.balanced_by_month(rows.selectExpr("*", "2026 as year", "1 as month"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan._jdf.queryExecution().executedPlan().toString()


def test_month_keys():
    assert monthly.month_keys("2025-12-15", "2026-02-01") == [(2025, 12), (2026, 1), (2026, 2)]
    with pytest.raises(ValueError):
        monthly.month_keys("2026-02-01", "2025-12-15")


@pytest.fixture()
def split_dataset(spark, folder):
    path = f"{folder}/split-input"
    rows = [("2026-01-15", "1"), ("2026-02-15", "2"), ("2026-03-15", "3"), ("2026-04-15T13:00:00", "4")]
    monthly.write_monthly(dated(spark, rows), path, T)
    return path


def test_split_and_metadata(spark, split_dataset, folder):
    found = splits.create_split(spark, split_dataset, T, "2026-01-01", "2026-03-15", "2026-04-15", folder, "oot")
    assert (found["train_rows"], found["test_rows"]) == (2, 2)
    assert found["test_end"] == dt.datetime(2026, 4, 15, 13)
    whole = spark.read.parquet(f"{folder}/oot")
    assert values(whole.where("split = 'train'")) == ["1", "2"]
    text = splits.read_split_metadata(spark, folder, "oot")
    assert text["train_start"] == "2026-01-15T00:00:00" and text["test_rows"] == "2"


def test_exact_end_stops_at_midnight(spark, split_dataset, folder):
    found = splits.create_split(
        spark, split_dataset, T, "2026-01-01", "2026-03-15", "2026-04-15", folder, "exact", exact_end=True
    )
    assert found["test_rows"] == 1


@pytest.mark.parametrize(
    ("start", "split", "end"),
    [
        ("2026-03-15", "2026-03-15", "2026-04-15"),
        ("2026-01-01", "2026-05-01", "2026-04-15"),
        ("2026-03-01", "2026-03-02", "2026-04-15"),
        ("2026-01-01", "2026-03-20", "2026-04-10"),
    ],
)
def test_split_errors(spark, split_dataset, folder, start, split, end):
    with pytest.raises(ValueError):
        splits.create_split(spark, split_dataset, T, start, split, end, folder, "bad")


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)


HEADER = "CustomerID,Age,Tenure,Usage Frequency,Support Calls,Payment Delay,Last Interaction,total_spend,Gender,Subscription Type,Contract Length,Churn"


def customer_csv(path, rows):
    write_text(path, "\n".join([HEADER, *[",".join(map(str, r)) for r in rows]]) + "\n")


def test_raw_csv(spark, folder):
    write_text(f"{folder}/raw.csv", "Customer ID, Extra Value ,Churn\n1,x,0\n2,y,1\n3,,\n")
    df = delimited.read_raw_csv(spark, f"{folder}/raw.csv", "Customer ID", [" Extra Value ", "absent"])
    assert df.columns == ["customer_id", "churn"]
    assert sorted(r["customer_id"] for r in df.collect()) == ["1", "2"]


def test_run_files(spark, folder):
    write_text(f"{folder}/0001_sample_predictions.csv", "prediction\n1\n0\n")
    write_text(f"{folder}/0042_sample_predictions.csv", "prediction\n1\n")
    write_text(f"{folder}/notes.csv", "prediction\n9\n")
    write_text(f"{folder}/0007_sample_predictions.csv/part-0.csv", "prediction\n5\n")
    rows = delimited.read_run_files(spark, folder).collect()
    assert sorted((r["run_id"], r["prediction"]) for r in rows) == [
        ("0001", "0"), ("0001", "1"), ("0007", "5"), ("0042", "1"),
    ]
    assert delimited.read_run_files(spark, f"{folder}/0007_sample_predictions.csv").columns == ["run_id"]


def test_event_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([("2026-02-01T01:30:00+01:00",), ("2026-02-01T00:30:00",), ("2026-02-01T00:30:00Z",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = rows.select(utc_naive(F.col("t"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r[0] for r in got} == {dt.datetime(2026, 2, 1, 0, 30)}


def test_ingested_run_files(spark, folder):
    header = HEADER.lower().replace(" ", "_") + ",reference_date"
    body = [header, *[",".join(map(str, r)) + ",2026-02-03" for r in customer_rows(4)]]
    write_text(f"{folder}/runs/0001_sample_predictions.csv", "\n".join(body) + "\n")
    ingest_runs(spark, f"{folder}/runs", f"{folder}/out", CHURN)
    assert monthly.read_monthly(spark, f"{folder}/out", T).count() == 4


def test_reference_dates_csv(spark, folder):
    customer_csv(f"{folder}/raw.csv", customer_rows(12))
    add_reference_dates(spark, f"{folder}/raw.csv", f"{folder}/dated", "2026-01-01", "2026-05-01", CHURN)
    df = delimited.read_scored_csv(spark, f"{folder}/dated", CHURN.rules)
    counts = sorted(r["count"] for r in df.groupBy(T).count().collect())
    assert counts == [2, 2, 2, 3, 3]
    prepare_data(spark, f"{folder}/dated", f"{folder}/monthly", CHURN)
    assert monthly.read_monthly(spark, f"{folder}/monthly", T, "2026-01-01", "2026-02-28").count() in (4, 5, 6)


FEATURE_JSON = dict(zip(CHURN.feature_columns, customer_rows(1)[0][1:11]))


def event_line(kind="prediction", **extra):
    record = {
        "event": kind, "request_id": "r1", T: "2026-02-01T01:30:00+01:00", "latency_ms": 12.5,
        "model_name": "m", "model_alias": "champion", "model_version": 3, "features": FEATURE_JSON,
    }
    return json.dumps(record | extra)


def test_event_log_is_flattened(spark, folder):
    lines = [event_line(predicted_class=1, predicted_probability=0.7, threshold=0.5), event_line(latency_ms="fast")]
    write_text(f"{folder}/log.jsonl", "\n".join(lines) + "\n")
    rows = events.load_events(spark, f"{folder}/log.jsonl", events.PREDICTION, CHURN).collect()
    assert [r["latency_ms"] for r in rows] == [12.5, None]
    assert rows[0][T] == dt.datetime(2026, 2, 1, 0, 30) and rows[0]["age"] == 20 and rows[0]["gender"] == "Female"


def test_malformed_lines(spark, folder):
    write_text(f"{folder}/log.jsonl", event_line() + "\nnot json\n")
    good, bad = events.read_event_lines(spark, f"{folder}/log.jsonl", events.event_schema(CHURN))
    assert good.count() == 1 and [r[0] for r in bad.collect()] == ["not json"]
    assert events.read_event_json(spark, f"{folder}/log.jsonl", CHURN, strict=True).count() == 0


def test_ingestion_keeps_malformed_lines(spark, folder):
    lines = [event_line(), "not json", event_line(**{T: "yesterday"})]
    write_text(f"{folder}/log.jsonl", "\n".join(lines) + "\n")
    for _ in range(2):
        ingest_events(spark, f"{folder}/log.jsonl", f"{folder}/data", CHURN)
    assert spark.read.parquet(f"{folder}/data").count() == 1
    bad = spark.read.text(malformed_folder(f"{folder}/data", f"{folder}/log.jsonl"))
    assert sorted(r[0] for r in bad.collect()) == sorted(lines[1:])
    ingest_events(spark, f"{folder}/log.jsonl", f"{folder}/strict", CHURN, strict=True)
    assert not os.path.exists(f"{folder}/strict")


def test_missing_logs(spark, folder):
    assert events.read_event_json(spark, f"{folder}/absent", CHURN).count() == 0
    assert events.load_events(spark, None, events.PREDICTION_ERROR, CHURN).count() == 0
    assert events.load_events(spark, f"{folder}/absent", events.PREDICTION_ERROR, CHURN).count() == 0
    with pytest.raises(ValueError):
        events.load_events(spark, None, events.PREDICTION, CHURN)
    with pytest.raises(AnalysisException):
        events.load_events(spark, f"{folder}/absent", events.PREDICTION, CHURN)


def test_foreign_events_and_missing_fields(spark, folder):
    write_text(f"{folder}/log.jsonl", event_line("prediction_error"))
    with pytest.raises(ValueError, match="not 'prediction'"):
        events.load_events(spark, f"{folder}/log.jsonl", events.PREDICTION, CHURN)
    write_text(f"{folder}/short.jsonl", json.dumps({"event": "prediction", "request_id": "a"}))
    with pytest.raises(ValueError, match="latency_ms"):
        events.load_events(spark, f"{folder}/short.jsonl", events.PREDICTION, CHURN)


def test_written_events_leave_nulls_out(spark, folder, customers):
    scored = customers.limit(1).selectExpr(
        "*", "'r' as request_id", "timestamp_ntz'2026-01-01 00:00:00' as reference_date", "1.5D as latency_ms",
        "'m' as model_name", "1 as model_version", "1 as predicted_class", "0.7D as predicted_probability",
    )
    events.write_events(events.prediction_records(scored, CHURN, log_features=False), f"{folder}/log")
    line = spark.read.text(f"{folder}/log").first()[0]
    assert "threshold" not in line and "features" not in line and '"reference_date":"2026-01-01T00:00:00.000000Z"' in line
    events.json_to_csv(spark, f"{folder}/log", f"{folder}/csv", CHURN)
    assert spark.read.csv(f"{folder}/csv", header=True).first()["request_id"] == "r"


def test_ingested_log_replaces_its_month(spark, folder):
    write_text(f"{folder}/log.jsonl", event_line(predicted_class=1))
    for _ in range(2):
        ingest_events(spark, f"{folder}/log.jsonl", f"{folder}/ds", CHURN)
    assert monthly.read_monthly(spark, f"{folder}/ds", T).count() == 1
    ingest_events(spark, f"{folder}/absent.jsonl", f"{folder}/other", CHURN)
    assert not os.path.exists(f"{folder}/other")


def run_record(**changes):
    record = {
        "schema_version": 3,
        "run": {"id": "r", "name": "n"},
        "model": {"use_case": "churn", "name": "churn-model", "version": 1, "reference": {"uri": "/m", "model_id": "r"}},
        "data": {"target_column": "churn", "time_column": T, "split": {"name": "s", "metadata": {"train_rows": "3"}}},
        "training": {
            "classifier": {"name": "LogisticRegression", "alias": "lr"},
            "features": {"count": 1, "names_in": ["a"], "names_out": ["a"]},
            "tuning": {"enabled": False}, "n_jobs": 1, "calibration": {"method": "none"},
            "threshold": {"strategy": "max_f1", "selected_on": "out_of_time_test", "value": 0.4},
        },
        "evaluation": {"metrics": {"roc_auc": 0.9}},
        "lifecycle": {"registration": {"enabled": True}, "promotion": {"enabled": False, "decision": {
            "candidate_score": None, "champion_score": None, "score_delta": None, "min_delta": None,
            "promote": None, "reason": None}}},
        "parameters": {}, "tags": {},
    }
    return record | changes


def test_run_table_round_trip(spark, folder):
    append_run(spark, f"{folder}/runs", run_record())
    append_run(spark, f"{folder}/runs", run_record(run={"id": "r2", "name": "n"}))
    assert {r["run"]["id"] for r in read_runs(spark, f"{folder}/runs").collect()} == {"r", "r2"}


@pytest.mark.parametrize("version", [0, 1, 2])
def test_unsupported_run_versions(spark, folder, version):
    with pytest.raises(ValueError, match="schema_version"):
        append_run(spark, f"{folder}/runs", run_record(schema_version=version))


def test_broken_run_files(spark, folder):
    write_text(f"{folder}/a/run.json", json.dumps(run_record(evaluation={"metrics": {"roc_auc": "high"}})))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_runs(spark, f"{folder}/a").collect()
    record = run_record()
    del record["training"]
    write_text(f"{folder}/b/run.json", json.dumps(record))
    with pytest.raises(ValueError, match="training"):
        read_runs(spark, f"{folder}/b")


def test_registry(spark, folder):
    registry = ModelRegistry(spark, f"{folder}/store")
    assert registry.version_of("m", "champion") is None
    assert registry.register("m", "r1", "churn", 0.4, "/p1", {"f1": 0.5}) == 1
    assert registry.register("m", "r2", "churn", 0.6, "/p2", {"f1": 0.7}) == 2
    registry.promote("m", 1, True)
    registry.promote("m", 2, True)
    assert registry.version_of("m", "champion") == 2 and registry.version_of("m", "former_champion") == 1
    assert registry.metrics_of("m", "champion") == {"f1": 0.7}
    assert registry.resolve("m", "churn", alias="champion")["threshold"] == 0.6
    with pytest.raises(ValueError):
        registry.resolve("m", "churn")
    with pytest.raises(ValueError):
        registry.resolve("m", "churn", alias="champion", version=1)
    with pytest.raises(ValueError, match="other"):
        registry.resolve("m", "other", version=1)
    with pytest.raises(LookupError):
        registry.resolve("m", "churn", version=9)
    with pytest.raises(ValueError):
        registry.promote("m", 2, False)


def test_check_runs_is_lazy_on_valid_rows(spark, folder):
    append_run(spark, f"{folder}/runs", run_record())
    runs = read_runs(spark, f"{folder}/runs", check=False)
    assert check_runs(runs) is runs
    assert runs.select(F.col("evaluation.metrics")["roc_auc"]).first()[0] == 0.9
