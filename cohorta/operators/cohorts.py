"""Monitoring cohorts and their monthly summaries."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.contracts import UseCase
from cohorta.functions.scalars import (
    normalize_names,
    period_start,
    ratio,
    ratio_or_zero,
    require_columns,
)
from cohorta.operators.joins import full_outer_all, join_on_keys
from cohorta.operators.metrics import ranked, roc_auc_value, rows_where
from cohorta.operators.prefix import quantile_cuts
from cohorta.operators.ranks import percentile_columns, value_positions
from cohorta.operators.validation import with_reasons
from cohorta.session import materialize

PROBABILITY = "predicted_probability"
PREDICTED = "predicted_class"
VERSION = "model_version"
PERIOD = "period"
SOURCE = "source"
LATENCY = "latency_ms"

# Where a cohort may come from.
SOURCES = ("batch", "api")


def report_keys(time_column: str) -> list[str]:
    return [PERIOD, VERSION, time_column]


@dataclass(frozen=True)
class Cohort:
    """Checked rows and a written table of the periods each model version covers (first, last)."""

    rows: DataFrame
    versions: DataFrame

    def only(self, versions: DataFrame) -> Cohort:
        return Cohort(keep_versions(self.rows, versions), keep_versions(self.versions, versions))


def check_cohort(
    df: DataFrame,
    name: str,
    source: str,
    use_case: UseCase,
    require_predictions: bool = True,
    require_target: bool = False,
    require_features: bool = False,
    period: str = "month",
) -> Cohort:
    """Normalised, checked cohort with source, period and truncated time.

    All value checks and the covered time spans come from one map-side aggregate per model
    version, which is written, whatever the number of versions; the driver gets its sums. Feature
    columns are replaced by their contract-typed form.
    """
    time, target = use_case.time_column, use_case.target_column
    cohort = normalize_names(df)
    if require_features:
        require_columns(cohort, use_case.feature_columns, f"{name} features")
    needed = [VERSION, time]
    if require_predictions:
        needed += [PROBABILITY, PREDICTED]
    if require_target:
        needed.append(target)
    require_columns(cohort, needed, name)

    checks, casts = {}, {VERSION: F.col(VERSION).cast("int")}
    if require_features:
        for rule in use_case.feature_rules:
            casts[rule.name] = rule.typed()
            for label, broken in rule.failures():
                checks[f"{rule.name} {label}"] = broken
    if require_predictions:
        probability = F.col(PROBABILITY).try_cast("double")
        predicted = F.col(PREDICTED).try_cast("int")
        checks["probability outside [0, 1]"] = ~F.coalesce(
            probability.between(0, 1) & ~F.isnan(probability), F.lit(False)
        )
        checks["class outside {0, 1}"] = ~F.coalesce(predicted.isin(0, 1), F.lit(False))
        casts[PROBABILITY] = F.col(PROBABILITY).cast("double")
        casts[PREDICTED] = F.col(PREDICTED).cast("int")
    if require_target:
        checks["missing label"] = F.col(target).isNull()
    moment = period_start(F.col(time), period)
    wanted = [F.count_if(broken).alias(f"c{i}") for i, broken in enumerate(checks.values())]
    wanted += [F.min(moment).alias("first"), F.max(moment).alias("last")]
    if require_target:
        wanted += [F.min(target).alias("low"), F.max(target).alias("high")]
    by_version = cohort.groupBy(F.col(VERSION).try_cast("int").alias(VERSION)).agg(*wanted)
    spans = materialize(by_version, "versions")
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(checks))]
    if require_target:
        sums += [F.min("low").alias("low"), F.max("high").alias("high")]
    found = spans.agg(F.count_if(F.col(VERSION).isNull()).alias("unnamed"), *sums).first()

    broken = {label: found[f"c{i}"] for i, label in enumerate(checks)}
    broken["missing model version"] = found["unnamed"]
    broken = {label: count for label, count in broken.items() if count}
    if broken:
        raise ValueError(f"{name} cohort is invalid: {broken}.")
    if require_target and found["low"] == found["high"]:
        raise ValueError(f"{name} cohort needs both target classes.")

    casts[time] = moment
    rows = cohort.withColumns(casts).select(
        F.lit(source).alias(SOURCE), F.lit(name).alias(PERIOD), *cohort.columns
    )
    return Cohort(rows, spans.select(VERSION, "first", "last"))


def prepare_cohort(df: DataFrame, name: str, source: str, use_case: UseCase, **options) -> DataFrame:
    """The rows of ``check_cohort``."""
    return check_cohort(df, name, source, use_case, **options).rows


def filter_version(df: DataFrame, model_version: int | None) -> DataFrame:
    return df if model_version is None else df.where(F.col(VERSION) == model_version)


def version_overlap(reference: DataFrame, analysis: DataFrame) -> DataFrame:
    """(model_version, presence): common, reference_only or analysis_only."""
    marked = (
        reference.select(VERSION, F.lit(1).alias("side"))
        .unionByName(analysis.select(VERSION, F.lit(2).alias("side")))
        .groupBy(VERSION)
        .agg(F.bit_or("side").alias("sides"))
    )
    presence = (
        F.when(F.col("sides") == 3, "common")
        .when(F.col("sides") == 1, "reference_only")
        .otherwise("analysis_only")
    )
    return marked.select(VERSION, presence.alias("presence"))


def common_versions(reference: DataFrame, analysis: DataFrame) -> DataFrame:
    return version_overlap(reference, analysis).where("presence = 'common'").select(VERSION)


def keep_versions(df: DataFrame, versions: DataFrame) -> DataFrame:
    return df.join(versions, VERSION, "left_semi")


def overlap_guard(
    reference: DataFrame, analysis: DataFrame, errors: DataFrame | None, time_column: str
) -> DataFrame:
    """One row: last reference period, first monitored period, and whether they overlap."""
    monitored = analysis.select(time_column)
    if errors is not None:
        monitored = monitored.unionByName(errors.select(time_column))
    tagged = reference.select(F.col(time_column).alias("reference_time"), F.lit(None).cast("timestamp_ntz").alias("monitored_time")).unionByName(
        monitored.select(F.lit(None).cast("timestamp_ntz").alias("reference_time"), F.col(time_column).alias("monitored_time"))
    )
    return tagged.agg(
        F.max("reference_time").alias("reference_end"),
        F.min("monitored_time").alias("monitored_start"),
    ).withColumn("overlaps", F.col("monitored_start") <= F.col("reference_end"))


def union_cohorts(*cohorts: DataFrame) -> DataFrame:
    """Union of cohorts whose columns differ; absent columns become null."""
    whole = cohorts[0]
    for cohort in cohorts[1:]:
        whole = whole.unionByName(cohort, allowMissingColumns=True)
    return whole


ROWS = "rows"


def prediction_cells(df: DataFrame, use_case: UseCase) -> DataFrame:
    """Predictions of one report key that share score, class and label, and how many ``rows`` they are."""
    target = [use_case.target_column] if use_case.target_column in df.columns else []
    same = [SOURCE, *report_keys(use_case.time_column), PROBABILITY, PREDICTED, *target]
    return df.groupBy(*same).agg(F.count(F.lit(1)).alias(ROWS))


def base_summary(df: DataFrame, time_column: str, rows: str | None = None) -> DataFrame:
    """Prediction count, mean probability and positive-class rate per report key.

    Here and below, ``rows`` names how many rows a row stands for.
    """
    if rows is not None:
        n, known = F.col(rows), F.sum(rows)
        return df.groupBy(SOURCE, *report_keys(time_column)).agg(
            known.alias("prediction_count"),
            (F.sum(F.col(PROBABILITY) * n) / known).alias("avg_predicted_probability"),
            (F.sum(F.col(PREDICTED).cast("double") * n) / known).alias("predicted_positive_rate"),
        )
    return df.groupBy(SOURCE, *report_keys(time_column)).agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg(PROBABILITY).alias("avg_predicted_probability"),
        F.avg(F.col(PREDICTED).cast("double")).alias("predicted_positive_rate"),
    )


def realized_metrics(
    df: DataFrame, use_case: UseCase, cuts: list[float] | None = None, rows: str | None = None
) -> DataFrame | None:
    """Observed rate, precision, recall and ROC AUC of labelled rows per report key.

    Groups without labels do not appear; None without a target column.
    """
    if use_case.target_column not in df.columns:
        return None
    keys = report_keys(use_case.time_column)
    positive = F.col(use_case.target_column).cast("int") == 1
    hit = F.col(PREDICTED) == 1
    cells = (
        df.where(F.col(use_case.target_column).isNotNull())
        .groupBy(*keys, F.col(PROBABILITY).alias("score"))
        .agg(
            rows_where(positive & hit, rows).alias("tp"),
            rows_where(positive & ~hit, rows).alias("fn"),
            rows_where(~positive & hit, rows).alias("fp"),
            rows_where(~positive & ~hit, rows).alias("tn"),
        )
    )
    by_score = cells.withColumns(
        {"pos": F.col("tp") + F.col("fn"), "neg": F.col("fp") + F.col("tn")}
    )
    if cuts is None:
        cuts = quantile_cuts(df, PROBABILITY)
    tp, fp, pos = F.sum("tp"), F.sum("fp"), F.sum("pos")
    return (
        ranked(by_score, cuts, keys)
        .groupBy(*keys)
        .agg(
            ratio(pos, pos + F.sum("neg")).alias("observed_positive_rate"),
            ratio_or_zero(tp, tp + fp).alias("realized_precision"),
            ratio_or_zero(tp, pos).alias("realized_recall"),
            roc_auc_value().alias("realized_roc_auc"),
        )
    )


def operational_summary(success: DataFrame, errors: DataFrame, time_column: str) -> DataFrame:
    """Request count, latency percentiles and error rate per report key.

    Both outcomes share one pass: the outcome is part of the group, so no join is needed.
    """
    keys = report_keys(time_column)
    events = success.select(*keys, LATENCY, F.lit("ok").alias("outcome")).unionByName(
        errors.select(*keys, LATENCY, F.lit("error").alias("outcome"))
    )
    ok, failed = F.col("outcome") == "ok", F.col("outcome") == "error"
    summary = (
        value_positions(events, LATENCY, [*keys, "outcome"])
        .groupBy(*keys)
        .agg(
            F.sum(F.when(ok, F.col("rows")).otherwise(0)).alias("_ok"),
            F.sum(F.when(failed, F.col("rows")).otherwise(0)).alias("_failed"),
            *percentile_columns(
                {"prediction_latency_p50_ms": 0.5, "prediction_latency_p95_ms": 0.95}, ok
            ),
            *percentile_columns(
                {"api_error_latency_p50_ms": 0.5, "api_error_latency_p95_ms": 0.95}, failed
            ),
        )
    )
    requests = F.col("_ok") + F.col("_failed")
    return summary.withColumns(
        {"api_request_count": requests, "api_error_rate": ratio(F.col("_failed"), requests)}
    ).drop("_ok", "_failed")


def merge_latency_summaries(success: DataFrame, errors: DataFrame, time_column: str) -> DataFrame:
    """Full outer merge of separately computed outcome summaries (counts default to zero).

    ``success`` carries ``api_success_count``, ``errors`` carries ``api_error_count``.
    """
    merged = join_on_keys(success, errors, report_keys(time_column), "full_outer")
    ok = F.coalesce(F.col("api_success_count"), F.lit(0))
    failed = F.coalesce(F.col("api_error_count"), F.lit(0))
    return merged.withColumns(
        {"api_request_count": ok + failed, "api_error_rate": ratio(failed, ok + failed)}
    ).drop("api_success_count", "api_error_count")


def monthly_kpis(df: DataFrame, target: str, time_column: str, period: str = "month") -> DataFrame:
    """Mean target, probability and class per period, oldest first."""
    return (
        df.groupBy(period_start(F.col(time_column), period).alias(time_column))
        .agg(
            F.avg(F.col(target).cast("double")).alias("mean_target"),
            F.avg(PROBABILITY).alias("mean_probability"),
            F.avg(F.col(PREDICTED).cast("double")).alias("mean_class"),
        )
        .orderBy(time_column)
    )


def kpi_overview(kpis: DataFrame, tables: Iterable[DataFrame], time_column: str) -> DataFrame:
    """Monthly KPIs of one model version next to its drift tables, full outer on the time."""
    by_time = [table.drop(PERIOD, VERSION) for table in tables]
    return full_outer_all([kpis, *by_time], [time_column]).orderBy(time_column)


def quarantine_errors(errors: DataFrame, use_case: UseCase) -> tuple[DataFrame, DataFrame]:
    """(error events whose features satisfy the contract, the others with reasons)."""
    marked = with_reasons(errors, use_case.feature_rules, "_reasons")
    good = marked.where(F.size("_reasons") == 0).drop("_reasons")
    return good, marked.where(F.size("_reasons") > 0)


