"""Streaming jobs run to completion over events derived from the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.functions.features import rule_classifier
from cohorta.plans import views as V
from cohorta.plans.scoring import RuleScorer
from cohorta.session import new_workspace
from cohorta.sources import events as E
from cohorta.sources.monthly import read_monthly
from cohorta.streaming import jobs as J
from registered.derived import API, CUSTOMERS, with_views

TIME = "reference_date"


def _event_folder(spark, sf_dir, repeat=False):
    """All service events as JSON lines; optionally every event twice."""
    path = new_workspace(spark, "events")
    rows = V.api_events(spark, sf_dir)
    ok = E.prediction_records(rows.where(F.col("event") == E.PREDICTION), V.REQUESTS)
    failed = E.error_records(
        rows.where(F.col("event") == E.PREDICTION_ERROR).withColumns(
            {"error_type": F.lit("ValueError"), "error_message": F.lit("bad input")}
        ),
        V.REQUESTS,
    )
    for _ in range(2 if repeat else 1):
        E.write_events(ok, path)
        E.write_events(failed, path)
    return path


def stream_ingest(spark, sf_dir):
    """Events streamed into a monthly dataset, started twice over the same folder."""
    source, target, checkpoint = (
        _event_folder(spark, sf_dir), new_workspace(spark, "dataset"), new_workspace(spark, "checkpoint"),
    )
    for _ in range(2):
        J.ingest_stream(J.stream_events(spark, source, V.REQUESTS), target, checkpoint, TIME).awaitTermination()
    rows = read_monthly(spark, target, TIME)
    return rows.groupBy("event", "year", "month", "model_version").agg(F.count(F.lit(1)).alias("rows"))


def stream_dedup(spark, sf_dir):
    """Every event arrives twice; request ids are counted once."""
    source, target, checkpoint = (
        _event_folder(spark, sf_dir, repeat=True), new_workspace(spark, "unique"), new_workspace(spark, "checkpoint"),
    )
    unique = J.deduplicated(J.stream_events(spark, source, V.REQUESTS), TIME, "40 days")
    J.ingest_stream(unique, target, checkpoint, TIME).awaitTermination()
    rows = read_monthly(spark, target, TIME)
    return rows.groupBy("event", "model_version").agg(F.count(F.lit(1)).alias("rows"))


def stream_kpis(spark, sf_dir):
    """Requests, error rate and latency percentiles per version and day, each window once it is complete.

    A later marker event moves the watermark past the last real window; its own window stays open.
    """
    source, target, checkpoint = (
        _event_folder(spark, sf_dir), new_workspace(spark, "kpis"), new_workspace(spark, "checkpoint"),
    )
    marker = V.api_events(spark, sf_dir).where(F.col("event") == E.PREDICTION).agg(
        F.lit("marker").alias("request_id"),
        (F.max(TIME) + F.expr("interval 60 days")).alias(TIME),
        *[F.max(c).alias(c) for c in ("latency_ms", "model_name", "model_version", "predicted_class", "predicted_probability", "amount", "k", "channel")],
    )
    E.write_events(E.prediction_records(marker, V.REQUESTS), source)
    events = J.stream_events(spark, source, V.REQUESTS).withColumn(TIME, F.col(TIME).cast("timestamp"))
    query = (
        J.service_figures(events.withWatermark(TIME, "40 days"), TIME, "1 day")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(target).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "model_version",
        "api_request_count",
        *[F.round(name, 6).alias(name) for name in ("api_error_rate", "prediction_latency_p50_ms", "prediction_latency_p95_ms")],
    )


def stream_scored(spark, sf_dir):
    """Customers arrive as requests: valid ones are scored, the others become error events."""
    source, output, checkpoint = (
        new_workspace(spark, "requests"), new_workspace(spark, "answers"), new_workspace(spark, "checkpoint"),
    )
    rows = V.customers(spark, sf_dir).withColumns(
        {"request_id": F.col("customerid").cast("string"), TIME: F.lit("2026-01-01T00:00:00Z")}
    )
    rows.select("request_id", TIME, *CHURN.feature_columns).write.json(source)
    J.score_stream(
        spark, source, output, checkpoint, CHURN, RuleScorer(rule_classifier), 0.5, "rules", 1
    ).awaitTermination()
    predictions = E.read_event_json(spark, f"{output}/predictions", CHURN)
    errors = E.read_event_json(spark, f"{output}/errors", CHURN)
    return predictions.unionByName(errors).select(
        "request_id", "event", "predicted_class", "error_message", TIME
    )


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_kpis": stream_kpis,
    "stream_scored": stream_scored,
}

ORACLES = {
    "stream_ingest": with_views(
        API,
        query="""
SELECT event, year(reference_date)::INTEGER AS year, month(reference_date)::INTEGER AS month, model_version, count(*) AS rows
FROM api_events GROUP BY ALL""",
    ),
    "stream_dedup": with_views(
        API, query="SELECT event, model_version, count(DISTINCT request_id) AS rows FROM api_events GROUP BY ALL"
    ),
    # the middle of the bucket that holds the exact value of rank ceil(p n), within what the bucket holds
    "stream_kpis": with_views(
        API,
        query="""
, day AS (
  SELECT CAST(date_trunc('day', reference_date) AS TIMESTAMP) AS window_start, model_version, event, latency_ms,
         ceil(ln(latency_ms) / ln(1.005::DOUBLE / 0.995)) AS bucket
  FROM api_events
),
placed AS (
  SELECT *, greatest(min(latency_ms) OVER b, least(max(latency_ms) OVER b, pow(1.005::DOUBLE / 0.995, bucket) * 0.995)) AS near,
         row_number() OVER (PARTITION BY window_start, model_version, event ORDER BY latency_ms) AS place,
         count(*) OVER (PARTITION BY window_start, model_version, event) AS n
  FROM day WINDOW b AS (PARTITION BY window_start, model_version, event, bucket)
)
SELECT window_start, model_version, count(*) AS api_request_count,
       round(count(*) FILTER (event <> 'prediction') / count(*)::DOUBLE, 6) AS api_error_rate,
       round(max(near) FILTER (event = 'prediction' AND place = ceil(n * 0.5::DOUBLE)), 6) AS prediction_latency_p50_ms,
       round(max(near) FILTER (event = 'prediction' AND place = ceil(n * 0.95::DOUBLE)), 6) AS prediction_latency_p95_ms
FROM placed GROUP BY ALL""",
    ),
    "stream_scored": with_views(
        CUSTOMERS,
        query="""
SELECT customerid::VARCHAR AS request_id,
       CASE WHEN contract_length = 'Weekly' THEN 'prediction_error' ELSE 'prediction' END AS event,
       CASE WHEN contract_length = 'Weekly' THEN NULL WHEN age > 50 OR support_calls >= 6 OR payment_delay > 20
                 OR total_spend <= 500 OR contract_length = 'Monthly' THEN 1 ELSE 0 END AS predicted_class,
       CASE WHEN contract_length = 'Weekly' THEN 'contract_length:not_allowed' END AS error_message,
       '2026-01-01T00:00:00.000000Z' AS reference_date
FROM customers""",
    ),
}
