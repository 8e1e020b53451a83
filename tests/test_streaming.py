"""Streaming jobs run to completion on small folders."""

import datetime as dt
import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.functions.features import rule_classifier
from cohorta.operators.buckets import bucket_percentile, log_bucket
from cohorta.plans.scoring import RuleScorer
from cohorta.sources.events import read_event_json
from cohorta.sources.monthly import read_monthly
from cohorta.streaming import jobs as J
from tests.conftest import customer_rows

T = "reference_date"
FEATURES = dict(zip(CHURN.feature_columns, customer_rows(1)[0][1:11]))


def put(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as handle:
        handle.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def event(number, minute, kind="prediction", latency=10.0):
    moment = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=minute)
    return {"event": kind, "request_id": f"r{number}", T: moment.isoformat() + "Z", "latency_ms": latency,
            "model_name": "m", "model_version": 1, "features": FEATURES}


def test_ingestion_is_incremental(spark, folder):
    source, target, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    put(source, "a.json", [event(1, 0), "broken"])
    run = lambda: J.ingest_stream(J.stream_events(spark, source, CHURN), target, state, T).awaitTermination()
    run()
    run()
    assert read_monthly(spark, target, T).count() == 1
    put(source, "b.json", [event(2, 5)])
    run()
    assert sorted(r["request_id"] for r in read_monthly(spark, target, T).collect()) == ["r1", "r2"]


def test_lines_that_are_no_events_are_kept(spark, folder):
    put(f"{folder}/in", "a.json", [event(1, 0), "broken", event(2, 0) | {T: "garbage"}, event(3, 0) | {T: None}])
    J.ingest_stream(J.stream_events(spark, f"{folder}/in", CHURN), f"{folder}/out", f"{folder}/a", T).awaitTermination()
    J.stream_malformed(spark, f"{folder}/in", f"{folder}/bad", f"{folder}/b", CHURN).awaitTermination()
    bad = sorted(r[0] for r in spark.read.text(f"{folder}/bad").collect())
    assert bad[0] == "broken" and "garbage" in bad[1] and len(bad) == 2
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_an_unreadable_time_is_explained(spark, folder):
    requests = [{"request_id": "a", T: "garbage", **FEATURES}, {"request_id": "b", T: "2026-01-01T00:00:00Z", **FEATURES}]
    put(f"{folder}/in", "a.json", requests)
    J.score_stream(
        spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", CHURN, RuleScorer(rule_classifier), 0.5, "m", 7
    ).awaitTermination()
    assert [r["request_id"] for r in read_event_json(spark, f"{folder}/out/predictions", CHURN).collect()] == ["b"]
    failed = read_event_json(spark, f"{folder}/out/errors", CHURN).collect()
    assert [(r["request_id"], r["error_message"]) for r in failed] == [("a", f"{T}:wrong_type")]


def test_repeated_requests_are_dropped(spark, folder):
    put(f"{folder}/in", "a.json", [event(1, 0), event(1, 1), event(2, 2)])
    events = J.deduplicated(J.stream_events(spark, f"{folder}/in", CHURN), T)
    J.ingest_stream(events, f"{folder}/out", f"{folder}/state", T).awaitTermination()
    assert read_monthly(spark, f"{folder}/out", T).count() == 2


def test_windows_appear_once_the_watermark_has_passed(spark, folder):
    put(f"{folder}/in", "a.json", [event(1, 0), event(2, 10, latency=30.0), event(3, 20, "prediction_error", 95.0), event(4, 70)])
    put(f"{folder}/in", "b.json", [event(5, 600)])
    events = J.deduplicated(J.stream_events(spark, f"{folder}/in", CHURN), T, "30 minutes")
    query = (
        J.service_figures(events, T)
        .writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").orderBy("window_start").collect()
    assert [r["api_request_count"] for r in rows] == [3, 1]
    assert rows[0]["api_error_rate"] == pytest.approx(1 / 3)
    assert rows[0]["prediction_latency_p95_ms"] == 30.0


@pytest.mark.parametrize("error", [0.005, 0.05])
def test_bucket_percentiles_keep_their_error(spark, error):
    draw = random.Random(5)
    groups = {
        "spread": [10 ** draw.uniform(-4, 7) for _ in range(4000)],
        "hot": [20.0] * 3000 + [draw.uniform(1, 2) for _ in range(900)],
        "signs": [draw.uniform(-50, 50) for _ in range(999)] + [0.0, -0.0, 1e-12],
        "one": [7.25],
        "none": [None, float("nan"), float("inf"), float("-inf")],
    }
    rows = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double")
    parts = rows.repartition(7).groupBy("g", log_bucket(F.col("v"), error).alias("_bucket")).agg(
        F.count("*").alias("_n"), F.min("v").alias("_low"), F.max("v").alias("_high")
    )
    held = F.when(F.col("_bucket").isNotNull(), F.struct("_bucket", "_n", "_low", "_high"))
    whole = parts.groupBy("g").agg(F.array_sort(F.collect_list(held)).alias("h"))
    shares = (0.0, 0.01, 0.5, 0.95, 1.0)
    got = {r["g"]: r for r in whole.select("g", *[bucket_percentile(F.col("h"), s, error).alias(f"p{s}") for s in shares]).collect()}
    for group, values in groups.items():
        exact = sorted(v for v in values if v is not None and math.isfinite(v))
        for share in shares:
            if not exact:
                assert got[group][f"p{share}"] is None
                continue
            want = exact[max(1, math.ceil(share * len(exact))) - 1]
            assert got[group][f"p{share}"] == pytest.approx(want, rel=error * (1 + 1e-9), abs=1e-9)
    assert got["one"]["p0.5"] == 7.25 and got["hot"]["p0.95"] == 20.0
    with pytest.raises(ValueError):
        log_bucket(F.col("v"), 1.0)


def test_service_figures_merge_over_batches(spark, folder):
    """A window filled by several batches gives the same percentiles as one batch."""
    latencies = [float(1 + (i * 37) % 101) for i in range(101)]
    for part in range(3):
        put(f"{folder}/in", f"{part}.json", [event(i, i % 50, latency=latencies[i]) for i in range(part, 101, 3)])
    put(f"{folder}/in", "z.json", [event(999, 600)])
    lines = J.stream_lines(spark, f"{folder}/in", files_per_trigger=1)
    records = J.parse_event_lines(lines, J.event_schema(CHURN), T)
    events = J.flatten_features(records).withColumns({T: F.col(T).cast("timestamp"), "latency_ms": F.col("latency_ms").cast("double")})
    query = (
        J.service_figures(events.withWatermark(T, "2 hours"), T)
        .writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    row = spark.read.parquet(f"{folder}/out").collect()[0]
    assert row["api_request_count"] == 101
    assert (row["prediction_latency_p50_ms"], row["prediction_latency_p95_ms"]) == (51.0, 96.0)


def test_requests_are_scored_or_explained(spark, folder):
    good = {"request_id": "ok", T: "2026-01-01T00:00:00Z", **FEATURES}
    bad = {"request_id": "bad", **FEATURES, "age": 5, "gender": "x"}
    put(f"{folder}/in", "a.json", [good, bad])
    J.score_stream(
        spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", CHURN, RuleScorer(rule_classifier), 0.5, "m", 7
    ).awaitTermination()
    answer = read_event_json(spark, f"{folder}/out/predictions", CHURN).collect()
    assert [(r["request_id"], r["predicted_class"], r["model_version"]) for r in answer] == [("ok", 1, 7)]
    failed = read_event_json(spark, f"{folder}/out/errors", CHURN).collect()
    assert [(r["request_id"], r["error_type"]) for r in failed] == [("bad", "ContractError")]
    assert failed[0]["error_message"] == "age:out_of_range, gender:not_allowed"
    assert failed[0][T] is not None and float(failed[0]["latency_ms"]) > 0


def test_hot_requests_do_not_need_python(spark):
    frame = spark.range(3).select(
        F.col("id").cast("string").alias("request_id"), F.lit(None).cast("string").alias(T),
        F.current_timestamp().alias(J.ARRIVED),
        *[F.lit(str(v)).alias(k) for k, v in FEATURES.items()],
    )
    good, _ = J.route_requests(frame, CHURN, RuleScorer(rule_classifier), 0.5, "m", 1)
    assert "Python" not in good._jdf.queryExecution().executedPlan().toString()
