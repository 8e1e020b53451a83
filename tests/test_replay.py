"""Logs that grow are ingested again: every event and every malformed line once."""

import json

import pytest
from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.plans import replay as R
from tests.conftest import customer_rows

T = "reference_date"
FEATURES = dict(zip(CHURN.feature_columns, customer_rows(1)[0][1:11]))


def put(path, lines, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode, encoding="utf-8") as handle:
        handle.writelines(f"{line}\n" for line in lines)


def event(name, day="2026-01-05"):
    return json.dumps({"event": "prediction", "request_id": name, T: day and f"{day}T00:00:00Z", "latency_ms": 1.0,
                       "model_version": 1, "features": FEATURES})


def ids(spark, data, **bounds):
    return sorted(r["request_id"] for r in R.read_ingested(spark, data, CHURN, **bounds).collect())


def lines(spark, data):
    return sorted((r["log"].split("/")[-2], r["line"]) for r in R.read_malformed(spark, data, CHURN).collect())


def test_a_log_that_grew_replaces_only_itself(spark, folder, tmp_path):
    data, a, b = f"{folder}/data", tmp_path / "a" / "events.jsonl", tmp_path / "b" / "events.jsonl"
    put(a, [event("a1"), "broken", event("a2", "2026-02-01")])
    put(b, [event("b1"), "broken", "broken", event("b2", "garbage")])
    assert R.ingest_log(spark, str(a), data, CHURN) and R.ingest_log(spark, str(b), data, CHURN)
    assert not R.ingest_log(spark, str(a), data, CHURN)
    put(a, [event("a3"), "more", event("a4", None)], "a")
    assert [R.ingest_log(spark, str(a), data, CHURN) for _ in range(2)] == [True, False]
    assert ids(spark, data) == ["a1", "a2", "a3", "a4", "b1"]
    assert ids(spark, data, start="2026-02-01", end="2026-02-28") == ["a2"]
    bad = lines(spark, data)
    assert bad[:4] == [("a", "broken"), ("a", "more"), ("b", "broken"), ("b", "broken")] and "garbage" in bad[4][1] and len(bad) == 5
    now = {r["path"].split("/")[-2]: r for r in R.current_states(R.ledger(spark, data)).collect()}
    assert (now["a"]["events"], now["a"]["malformed"], now["a"]["months"]) == (4, 2, ["2026-01", "2026-02"])
    assert (now["b"]["events"], now["b"]["malformed"]) == (1, 3)
    assert [R.drop_superseded(spark, data) for _ in range(2)] == [1, 0]
    assert ids(spark, data) == ["a1", "a2", "a3", "a4", "b1"]


def test_a_log_written_anew_loses_its_old_months(spark, folder, tmp_path):
    data, log = f"{folder}/data", tmp_path / "x" / "log.jsonl"
    put(log, [event("old", "2025-12-01"), event("both")])
    R.ingest_log(spark, str(log), data, CHURN)
    put(log, [event("both")])
    R.ingest_log(spark, str(log), data, CHURN)
    assert ids(spark, data) == ["both"]


def test_a_job_that_dies_before_its_commit_leaves_nothing(spark, folder, tmp_path, monkeypatch):
    data, log = f"{folder}/data", tmp_path / "x" / "log.jsonl"
    put(log, [event("one")])
    R.ingest_log(spark, str(log), data, CHURN)
    put(log, [event("two"), "broken"], "a")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(R, "numbered_commit", die)
        with pytest.raises(RuntimeError):
            R.ingest_log(spark, str(log), data, CHURN)
    assert ids(spark, data) == ["one"] and lines(spark, data) == []
    assert R.ingest_log(spark, str(log), data, CHURN)
    assert ids(spark, data) == ["one", "two"] and lines(spark, data) == [("x", "broken")]


def test_absent_and_empty_logs(spark, folder, tmp_path):
    data = f"{folder}/data"
    assert R.ingest_log(spark, str(tmp_path / "none"), data, CHURN) is False
    assert ids(spark, data) == [] and lines(spark, data) == []
    put(tmp_path / "e" / "empty.jsonl", [])
    assert [R.ingest_log(spark, str(tmp_path / "e" / "empty.jsonl"), data, CHURN) for _ in range(2)] == [True, False]
    assert ids(spark, data) == []
    with pytest.raises(ValueError):
        R.read_ingested(spark, data, CHURN, start="2026-01-01")


def test_states_that_do_not_count_are_not_read(spark, folder, tmp_path):
    data, log = f"{folder}/data", tmp_path / "x" / "log.jsonl"
    put(log, [event("one")])
    R.ingest_log(spark, str(log), data, CHURN)
    plan = R.read_ingested(spark, data, CHURN)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    schema = {f.name: f.dataType.simpleString() for f in R.read_ingested(spark, data, CHURN).schema}
    assert schema[T] == "timestamp_ntz" and R.CORRUPT not in schema and "features" not in schema
    assert R.read_ingested(spark, data, CHURN).where(F.col("month") == 1).count() == 1
