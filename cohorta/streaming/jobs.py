"""Incremental ingestion, scoring with error routing, live service figures, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohorta.contracts import UseCase
from cohorta.functions.scalars import ratio, utc_naive
from cohorta.operators.cohorts import LATENCY, VERSION
from cohorta.operators.buckets import bucket_percentile, log_bucket
from cohorta.operators.validation import with_reasons
from cohorta.plans.scoring import Scorer, score_rows
from cohorta.sources.events import (
    CORRUPT,
    PREDICTION,
    PREDICTION_ERROR,
    error_records,
    event_schema,
    flatten_features,
    parse_event_lines,
    prediction_records,
)
from cohorta.sources.monthly import with_month


ARRIVED = "_arrived"


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Text lines of a growing folder; the file count per batch bounds its size."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def stream_requests(spark: SparkSession, folder: str, use_case: UseCase) -> DataFrame:
    """Request records with the moment their file arrived."""
    arrived = F.col("_metadata.file_modification_time").alias(ARRIVED)
    lines = stream_lines(spark, folder).select("value", arrived)
    return parse_event_lines(lines, request_schema(use_case))


def stream_events(spark: SparkSession, folder: str, use_case: UseCase) -> DataFrame:
    """Well-formed flattened events with naive UTC time and numeric latency.

    ``stream_malformed`` has the other lines.
    """
    time = use_case.time_column
    records = parse_event_lines(stream_lines(spark, folder), event_schema(use_case), time)
    good = flatten_features(records.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    return good.withColumns(
        {time: utc_naive(F.col(time)), LATENCY: F.col(LATENCY).try_cast("double")}
    )


def stream_malformed(
    spark: SparkSession, folder: str, target: str, checkpoint: str, use_case: UseCase
) -> StreamingQuery:
    """Write the lines that are no event, or whose time cannot be read, as text; each file exactly once."""
    schema, time = event_schema(use_case), use_case.time_column
    records = parse_event_lines(stream_lines(spark, folder), schema, time)
    return (
        records.where(F.col(CORRUPT).isNotNull())
        .select(F.col(CORRUPT).alias("value"))
        .writeStream.format("text")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(events: DataFrame, dataset: str, checkpoint: str, time_column: str) -> StreamingQuery:
    """Append new events to a monthly dataset, each file exactly once."""
    return (
        with_month(events, time_column)
        .writeStream.partitionBy("year", "month")
        .format("parquet")
        .option("path", dataset)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def deduplicated(events: DataFrame, time_column: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeated request ids that arrive within the watermark; state is bounded by it."""
    stamped = events.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return stamped.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["request_id"])


def service_figures(events: DataFrame, time_column: str, window: str = "1 hour", error: float = 0.005) -> DataFrame:
    """Requests, error rate and latency percentiles per version and time window.

    The input must carry a watermark on the time column. A percentile is the value of rank ceil(p n)
    up to the relative ``error``: the state holds counts of logarithmic buckets, which add up
    exactly in any order, and a window's buckets come together once it is complete. Buckets of one
    version and window are separate groups, so a hot version is not one task. Latencies that are
    null, NaN or infinite count as requests only.
    """
    ok, failed = F.col("event") == PREDICTION, F.col("event") == PREDICTION_ERROR
    bucket = F.when(ok, log_bucket(F.col(LATENCY), error))
    counted = events.groupBy(F.window(time_column, window).alias("_w"), VERSION, bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(failed).alias("_failed"),
        F.min(LATENCY).alias("_low"),
        F.max(LATENCY).alias("_high"),
    )
    held = F.when(F.col("_bucket").isNotNull(), F.struct("_bucket", "_n", "_low", "_high"))
    whole = counted.groupBy(F.window(F.window_time("_w"), window).alias("_w"), VERSION).agg(
        F.sum("_n").alias("api_request_count"), F.sum("_failed").alias("_failed"), F.collect_list(held).alias("_held")
    )
    return whole.withColumn("_held", F.array_sort("_held")).select(
        F.col("_w.start").alias("window_start"),
        VERSION,
        "api_request_count",
        ratio(F.col("_failed"), F.col("api_request_count")).alias("api_error_rate"),
        bucket_percentile(F.col("_held"), 0.5, error).alias("prediction_latency_p50_ms"),
        bucket_percentile(F.col("_held"), 0.95, error).alias("prediction_latency_p95_ms"),
    )


def request_schema(use_case: UseCase) -> T.StructType:
    """Requests carry an id, a time and the features as text; the contract types them."""
    text = T.StringType()
    names = ["request_id", use_case.time_column, *use_case.feature_columns]
    return T.StructType([T.StructField(n, text) for n in names] + [T.StructField(CORRUPT, text)])


def route_requests(
    requests: DataFrame,
    use_case: UseCase,
    scorer: Scorer,
    threshold: float,
    model_name: str,
    model_version: int,
) -> tuple[DataFrame, DataFrame]:
    """(prediction records, error records): valid requests are scored, the others explained.

    Latency is the time from the arrival of a request to the start of the batch that answers
    it. A request without a time gets the time of the batch; one whose time cannot be read is
    explained, too.
    """
    time = use_case.time_column
    now = F.current_timestamp()
    unread = F.col(time).isNotNull() & utc_naive(F.col(time)).isNull()
    marked = with_reasons(requests, use_case.feature_rules, "_reasons").withColumn(
        "_reasons", F.when(unread, F.array_append("_reasons", F.lit(f"{time}:wrong_type"))).otherwise(F.col("_reasons"))
    )
    marked = marked.withColumn(
        time,
        F.coalesce(utc_naive(F.col(time)), F.convert_timezone(None, F.lit("UTC"), now.cast("timestamp_ntz"))),
    )
    about = {"model_name": F.lit(model_name), VERSION: F.lit(model_version).cast("int")}
    latency = (F.unix_micros(now) - F.unix_micros(ARRIVED)) / 1000.0
    valid = marked.where(F.size("_reasons") == 0)
    features = {rule.name: rule.typed() for rule in use_case.feature_rules}
    scored = score_rows(
        valid.withColumns(features), scorer, use_case.feature_columns, threshold, model_version
    ).withColumns({**about, LATENCY: latency})
    failed = marked.where(F.size("_reasons") > 0).withColumns(
        {
            **about,
            LATENCY: latency,
            "error_type": F.lit("ContractError"),
            "error_message": F.concat_ws(", ", "_reasons"),
        }
    )
    return prediction_records(scored, use_case), error_records(failed, use_case)


def score_stream(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    use_case: UseCase,
    scorer: Scorer,
    threshold: float,
    model_name: str,
    model_version: int,
) -> StreamingQuery:
    """Score arriving requests; every batch writes its own prediction and error folders.

    A batch that is repeated after a failure overwrites its own folder, so each request is
    logged once.
    """
    requests = stream_requests(spark, folder, use_case)

    def write_batch(batch: DataFrame, number: int) -> None:
        batch.persist()
        predictions, errors = route_requests(
            batch.drop(CORRUPT), use_case, scorer, threshold, model_name, model_version
        )
        for records, kind in ((predictions, "predictions"), (errors, "errors")):
            records.write.mode("overwrite").json(f"{output}/{kind}/batch={number}")
        batch.unpersist()

    return (
        requests.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
