"""Append-only JSON event logs: predictions and prediction errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorta.contracts import UseCase
from cohorta.functions.scalars import require_columns, utc_naive

PREDICTION = "prediction"
PREDICTION_ERROR = "prediction_error"
CORRUPT = "_corrupt_record"


def event_schema(use_case: UseCase) -> T.StructType:
    """Log record of a use case. Times, latencies and features stay text until checked."""
    text, whole, real = T.StringType(), T.IntegerType(), T.DoubleType()
    # Field names of the event records.
    fields = [
        ("event", text),
        ("request_id", text),
        (use_case.time_column, text),
        ("latency_ms", text),
        ("model_name", text),
        ("model_alias", text),
        ("model_version", whole),
        ("predicted_class", whole),
        ("predicted_probability", real),
        ("threshold", real),
        ("error_type", text),
        ("error_message", text),
        ("traceback", text),
    ]
    features = T.StructType([T.StructField(name, text) for name in use_case.feature_columns])
    return T.StructType(
        [T.StructField(name, kind) for name, kind in fields]
        + [T.StructField("features", features), T.StructField(CORRUPT, text)]
    )


def flatten_features(df: DataFrame) -> DataFrame:
    """Nested feature fields as top-level columns; unchanged without a ``features`` object."""
    if "features" not in df.columns:
        return df
    inner = [F.col(f"features.{f.name}").alias(f.name) for f in df.schema["features"].dataType.fields]
    return df.select(*[c for c in df.columns if c != "features"], *inner)


def parse_event_lines(lines: DataFrame, schema: T.StructType, time_column: str | None = None) -> DataFrame:
    """Records of a table of JSON text lines (``value``); a malformed line keeps its text.

    With a time column, a line whose time cannot be read is malformed, too. Other columns of the
    table are kept.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [name for name in lines.columns if name != "value"]
    record = F.from_json("value", schema, options).alias("_e")
    parsed = lines.where(F.trim("value") != "").select(*others, "value", record).select(*others, "value", "_e.*")
    if time_column is not None:
        unread = F.col(time_column).isNotNull() & utc_naive(F.col(time_column)).isNull()
        parsed = parsed.withColumn(CORRUPT, F.coalesce(CORRUPT, F.when(unread, F.col("value"))))
    return parsed.drop("value")


def read_event_lines(
    spark: SparkSession, path: str, schema: T.StructType, time_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(well-formed flattened records, malformed lines); a missing path gives empty tables."""
    try:
        records = parse_event_lines(spark.read.text(path), schema, time_column)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        records = spark.createDataFrame([], schema)
    good = flatten_features(records.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    return good, records.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_event_json(
    spark: SparkSession, path: str, use_case: UseCase, strict: bool = False
) -> DataFrame:
    """Flattened log records. ``strict`` returns no record at all when any line is malformed."""
    good, bad = read_event_lines(spark, path, event_schema(use_case), use_case.time_column)
    return good.limit(0) if strict and not bad.isEmpty() else good


def write_malformed(malformed: DataFrame, target: str) -> None:
    """The malformed lines of a log as text; a repeated job replaces them."""
    malformed.select(CORRUPT).write.mode("overwrite").text(target)


def json_to_csv(spark: SparkSession, source: str, target: str, use_case: UseCase) -> None:
    """Log records as CSV; malformed lines go to a folder beside it, named ``-malformed``."""
    good, bad = read_event_lines(spark, source, event_schema(use_case), use_case.time_column)
    good.write.csv(target, header=True)
    write_malformed(bad, f"{target.rstrip('/')}-malformed")


def _columns_of(event: str, use_case: UseCase) -> list[str]:
    common = ["event", "request_id", use_case.time_column, "latency_ms", "model_name", "model_alias", "model_version"]
    outcome = (
        ["predicted_class", "predicted_probability", "threshold"]
        if event == PREDICTION
        else ["error_type", "error_message", "traceback"]
    )
    return [*common, *outcome, *use_case.feature_columns]


def load_events(
    spark: SparkSession,
    path: str | None,
    event: str,
    use_case: UseCase,
    strict: bool = False,
    malformed_to: str | None = None,
) -> DataFrame:
    """Checked events of one kind with naive UTC time and numeric latency.

    A missing error log is empty; a missing prediction log is an error. One aggregate checks
    the event kind and the required fields of every record. Malformed lines are written as text to
    ``malformed_to``, if it is given; ``strict`` loads nothing of a log that has any.
    """
    columns = _columns_of(event, use_case)
    time = use_case.time_column
    if path is None:
        if event == PREDICTION:
            raise ValueError("A prediction log is needed.")
        raw = spark.createDataFrame([], event_schema(use_case))
        events = flatten_features(raw.drop(CORRUPT))
    else:
        if event == PREDICTION:
            spark.read.text(path)  # raises when the path is absent
        events, malformed = read_event_lines(spark, path, event_schema(use_case), time)
        if malformed_to is not None:
            write_malformed(malformed, malformed_to)
        if strict and not malformed.isEmpty():
            events = events.limit(0)
    require_columns(events, columns, f"{event} log")
    found = events.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("event").eqNullSafe(event)).alias("foreign"),
        *[F.count(name).alias(f"has_{name}") for name in (time, "model_version", "latency_ms")],
    ).first()
    if found["foreign"]:
        raise ValueError(f"The log holds {found['foreign']} events that are not {event!r}.")
    absent = [n for n in (time, "model_version", "latency_ms") if found["rows"] and not found[f"has_{n}"]]
    if absent:
        raise ValueError(f"{event} events carry no {', '.join(absent)}.")
    typed = {rule.name: rule.typed() for rule in use_case.feature_rules if event == PREDICTION}
    return events.select(*columns).withColumns(
        {time: utc_naive(F.col(time)), "latency_ms": F.col("latency_ms").try_cast("double"), **typed}
    )


def _features_struct(columns: Sequence[str], keep: bool) -> list[Column]:
    return [F.struct(*columns).alias("features")] if keep else []


def _base_columns(event: str, use_case: UseCase) -> list[Column]:
    time = use_case.time_column
    stamp = F.date_format(F.col(time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return [
        F.lit(event).alias("event"),
        F.col("request_id"),
        stamp.alias(time),
        F.col("latency_ms"),
        F.col("model_name"),
        F.col("model_alias"),
        F.col("model_version"),
    ]


def prediction_records(scored: DataFrame, use_case: UseCase, log_features: bool = True) -> DataFrame:
    """Log records of successful predictions; absent optional columns become null."""
    rows = _with_optional(scored, {"model_alias": "string", "threshold": "double"})
    return rows.select(
        *_base_columns(PREDICTION, use_case),
        "predicted_class",
        "predicted_probability",
        "threshold",
        *_features_struct(use_case.feature_columns, log_features),
    )


def error_records(failed: DataFrame, use_case: UseCase, log_features: bool = True) -> DataFrame:
    """Log records of failed predictions."""
    rows = _with_optional(failed, {"model_alias": "string", "traceback": "string"})
    return rows.select(
        *_base_columns(PREDICTION_ERROR, use_case),
        "error_type",
        "error_message",
        "traceback",
        *_features_struct(use_case.feature_columns, log_features),
    )


def _with_optional(df: DataFrame, optional: dict[str, str]) -> DataFrame:
    absent = {n: F.lit(None).cast(kind) for n, kind in optional.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def write_events(records: DataFrame, path: str) -> None:
    """Append records as JSON lines; null fields are left out."""
    records.write.mode("append").option("ignoreNullFields", "true").json(path)
