"""The monitoring report: performance, drift and service figures per version and period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorta.contracts import UseCase
from cohorta.operators.cohorts import (
    LATENCY,
    PERIOD,
    PREDICTED,
    PROBABILITY,
    ROWS,
    SOURCES,
    VERSION,
    base_summary,
    check_cohort,
    common_versions,
    filter_version,
    operational_summary,
    overlap_guard,
    prediction_cells,
    quarantine_errors,
    realized_metrics,
    report_keys,
)
from cohorta.operators.drift import (
    REFERENCE,
    ReconstructionDrift,
    alert_counts,
    drift_population,
    estimated_performance,
    univariate_drift,
)
from cohorta.operators.joins import full_outer_all, join_on_keys
from cohorta.operators.prefix import quantile_cuts
from cohorta.operators.scores import fit_calibrators
from cohorta.session import materialize

DECIMALS = 4


def drift_tables(
    reference: DataFrame,
    analysis: DataFrame,
    errors: DataFrame | None,
    use_case: UseCase,
    cells: DataFrame,
    cuts: list[float],
    reconstruction: bool = True,
    calibrate: str = "auto",
) -> DataFrame:
    """Estimated performance from the written cells of both cohorts and alert counts, merged on the report keys."""
    time, features = use_case.time_column, list(use_case.feature_columns)
    keys = report_keys(time)
    tables = []
    if use_case.target_column in reference.columns:
        known = cells.where(F.col(PERIOD) == REFERENCE)
        maps = fit_calibrators(known, use_case.target_column, time, calibrate, ROWS) if calibrate != "never" else None
        tables.append(estimated_performance(cells, time, cuts, calibrators=maps, rows=ROWS))
    keep = [*keys, *features]
    base = reference.select(*keep)
    cohorts = base.unionByName(drift_population(analysis, errors, keep))
    if reconstruction:
        model = ReconstructionDrift(features, time, impute=False).fit(base)
        tables.append(alert_counts(model.calculate(cohorts), time, "reconstruction_drift"))
    tables.append(alert_counts(univariate_drift(cohorts, features, time), time, "univariate_drift"))
    return full_outer_all(tables, keys)


def round_numbers(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Half-even rounding of every fractional column, as scaling and rounding a double does.

    Sums of fractions differ in the last digits with the order of summation; a first rounding
    to ten decimals removes that before ties are decided.
    """
    scale = float(10**decimals)
    return df.select(
        *[
            (F.rint(F.round(f.name, 10) * scale) / scale).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def build_report(
    reference: DataFrame,
    analysis: DataFrame,
    use_case: UseCase,
    source_reference: str = "batch",
    source_analysis: str = "api",
    drift: bool = True,
    errors: DataFrame | None = None,
    model_version: int | None = None,
    period: str = "month",
    reconstruction: bool = True,
    calibrate: str = "auto",
    ordered: bool = True,
) -> DataFrame:
    """One row per (source, period, version, time) present in either cohort.

    Actions run while the plan is built: one check aggregate per cohort, cut points, and the
    drift fits. The checks write a table of versions; common versions and the overlap of the
    periods follow from these tables. The report itself stays lazy.
    """
    for source in (source_reference, source_analysis):
        if source not in SOURCES:
            raise ValueError(f"Unknown cohort source {source!r}; expected one of {SOURCES}.")
    time = use_case.time_column
    shared = {"require_features": drift, "period": period}
    before = check_cohort(
        reference, "reference", source_reference, use_case, require_target=True, **shared
    )
    after = check_cohort(analysis, "analysis", source_analysis, use_case, **shared)
    failed = None
    if errors is not None:
        # every failed request counts as one, whatever its payload
        failed = check_cohort(
            errors, "analysis", source_analysis, use_case, require_predictions=False, period=period
        )
    shared_versions = filter_version(common_versions(before.versions, after.versions), model_version)
    versions = materialize(shared_versions, "common")
    if versions.isEmpty():
        raise ValueError("The reference and analysis cohorts share no model version.")
    if failed is not None and model_version is not None:
        failed = failed.only(versions)
    before, after = before.only(versions), after.only(versions)

    ends, starts = before.versions.select(F.col("last").alias(time)), after.versions.select(F.col("first").alias(time))
    others = failed.versions.select(F.col("first").alias(time)) if failed is not None else None
    if drift and overlap_guard(ends, starts, others, time).first()["overlaps"]:
        drift = False

    keys = report_keys(time)
    # one pass over the predictions: all figures of scores, classes and labels start from these counts
    # and a cohort's source and period, the same in all its rows, are no keys of its count
    counted = [prediction_cells(side.rows, use_case) for side in (before, after)]
    cells = materialize(counted[0].unionByName(counted[1], allowMissingColumns=True), "prediction-cells")
    cuts = quantile_cuts(cells, PROBABILITY)
    report = base_summary(cells, time, ROWS)
    realized = realized_metrics(cells, use_case, cuts, ROWS)
    if realized is not None:
        report = join_on_keys(report, realized, keys, "left")
    if drift:
        # only inputs that satisfy the contract can be compared; quarantine_errors has the others
        known_errors = None
        if failed is not None:
            typed = {rule.name: rule.typed() for rule in use_case.feature_rules}
            known_errors = quarantine_errors(failed.only(versions).rows, use_case)[0].withColumns(typed)
        alerts = drift_tables(
            before.rows, after.rows, known_errors, use_case, cells, cuts, reconstruction, calibrate
        )
        report = join_on_keys(report, alerts, keys, "left")
    if source_analysis == "api":
        outcomes = failed.rows if failed is not None else after.rows.select(*keys, LATENCY).limit(0)
        operational = operational_summary(after.rows, outcomes, time)
        report = join_on_keys(report, operational, keys, "full_outer")
    report = round_numbers(report)
    return report.orderBy(VERSION, time, PERIOD) if ordered else report
