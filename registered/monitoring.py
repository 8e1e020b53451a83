"""Monitoring cohorts, drift and the report."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.operators import cohorts as C
from cohorta.operators import drift as D
from cohorta.operators import isotonic
from cohorta.operators import scores as S
from cohorta.plans import views as V
from cohorta.plans.monitoring import monitor_datasets, monitor_files
from cohorta.plans.report import build_report
from cohorta.session import new_workspace
from cohorta.sources.delimited import write_csv
from cohorta.sources.monthly import write_monthly
from registered.derived import API, COHORTS, SCORED, with_views

TIME = "reference_date"
KEYS = C.report_keys(TIME)


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(F.round(c, 10), digits) for c in columns})


def _prepared(spark, sf_dir, require_features=False):
    reference, analysis = V.scored_cohorts(spark, sf_dir)
    return (
        C.prepare_cohort(reference, "reference", "batch", V.RETURNS, require_target=True, require_features=require_features),
        C.prepare_cohort(analysis, "analysis", "batch", V.RETURNS, require_features=require_features),
    )


def _api(spark, sf_dir):
    reference, analysis, errors = V.api_cohorts(spark, sf_dir)
    day = {"period": "day"}
    return (
        C.prepare_cohort(reference, "reference", "batch", V.REQUESTS, require_target=True, **day),
        C.prepare_cohort(analysis, "analysis", "api", V.REQUESTS, **day),
        C.prepare_cohort(errors, "analysis", "api", V.REQUESTS, require_predictions=False, **day),
    )


def base_summary(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir)
    summary = C.base_summary(reference.unionByName(analysis), TIME)
    return rounded(summary, "avg_predicted_probability", "predicted_positive_rate")


def base_summary_by_day(spark, sf_dir):
    reference, analysis, _ = _api(spark, sf_dir)
    summary = C.base_summary(C.union_cohorts(reference, analysis), TIME)
    return rounded(summary, "avg_predicted_probability", "predicted_positive_rate")


def realized_metrics(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir)
    metrics = C.realized_metrics(reference.unionByName(analysis), V.RETURNS)
    return rounded(metrics, *[c for c in metrics.columns if c not in KEYS])


def operational_summary(spark, sf_dir):
    _, analysis, errors = _api(spark, sf_dir)
    summary = C.operational_summary(analysis, errors, TIME)
    return rounded(summary, *[c for c in summary.columns if c.endswith(("_ms", "_rate"))])


def version_overlap(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir)
    return C.version_overlap(reference, analysis.where("model_version <> 2"))


def version_restricted_counts(spark, sf_dir):
    """Rows per cohort after keeping the versions both cohorts share."""
    reference, analysis = _prepared(spark, sf_dir)
    analysis = analysis.where("model_version <> 2")
    shared = C.common_versions(reference, analysis)
    kept = C.keep_versions(reference, shared).unionByName(C.keep_versions(analysis, shared))
    return kept.groupBy("period", "model_version").agg(F.count(F.lit(1)).alias("rows"))


def version_filter(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir)
    kept = C.filter_version(reference, 2).unionByName(C.filter_version(analysis, 2))
    return kept.groupBy("period", "model_version").agg(F.count(F.lit(1)).alias("rows"))


def overlap_guard(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir)
    return C.overlap_guard(reference, analysis, None, TIME)


def monthly_kpis(spark, sf_dir):
    reference, analysis = V.scored_cohorts(spark, sf_dir)
    kpis = C.monthly_kpis(reference.unionByName(analysis), "returned", TIME)
    return rounded(kpis, "mean_target", "mean_probability", "mean_class")


def kpi_overview(spark, sf_dir):
    """KPIs, estimated ROC AUC and alert count of model version 1 by month."""
    reference, analysis = (C.filter_version(c, 1) for c in _prepared(spark, sf_dir, require_features=True))
    both = reference.unionByName(analysis)
    estimated = D.estimated_performance(both, TIME).select(*KEYS, "cbpe_roc_auc")
    alerts = D.alert_counts(D.univariate_drift(both, V.RETURNS.feature_columns, TIME), TIME, "univariate_drift")
    overview = C.kpi_overview(C.monthly_kpis(both, "returned", TIME), [estimated, alerts], TIME)
    return rounded(overview, "mean_target", "mean_probability", "mean_class", "cbpe_roc_auc")


def _js(spark, sf_dir, kind):
    reference, analysis = _prepared(spark, sf_dir, require_features=True)
    both = reference.unionByName(analysis)
    continuous, categorical = D.feature_kinds(both, V.RETURNS.feature_columns)
    if kind == "continuous":
        found = D.continuous_distances(both, continuous, TIME)
    else:
        found = D.categorical_distances(both, categorical, TIME)
    return rounded(D.with_alert(found), "distance")


def js_drift_categorical(spark, sf_dir):
    return _js(spark, sf_dir, "categorical")


def js_drift_continuous(spark, sf_dir):
    return _js(spark, sf_dir, "continuous")


def js_bins(spark, sf_dir):
    reference, _ = _prepared(spark, sf_dir)
    found = D.continuous_bins(reference, ["quantity", "discount", "extended_price"])
    return found.select("model_version", "feature", "low", "high", "bins", "as_category")


def drift_alert_counts(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir, require_features=True)
    both = reference.unionByName(analysis)
    alerts = D.univariate_drift(both, V.RETURNS.feature_columns, TIME)
    return D.alert_counts(alerts, TIME, "univariate_drift")


def cbpe_estimates(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir)
    found = D.estimated_performance(reference.unionByName(analysis), TIME)
    return rounded(found, "cbpe_precision", "cbpe_recall", "cbpe_roc_auc")


def _labelled_counts(spark, sf_dir):
    """Reference cohort as (version, held-out part, score) counts."""
    reference, _ = _prepared(spark, sf_dir)
    return S.score_counts(reference.withColumn("part", S.held_out_part(TIME)), "returned", C.PROBABILITY, [C.VERSION, "part"])


def isotonic_blocks(spark, sf_dir):
    """Blocks of the isotonic map of each version's scores; eight slices whatever the session."""
    counts = _labelled_counts(spark, sf_dir)
    blocks = isotonic.isotonic_blocks(counts, [C.VERSION], [i / 8 for i in range(1, 8)])
    rate = F.round(F.round(F.col("hits") / F.col("weight"), 10), 6)
    return blocks.select(C.VERSION, "low", "high", rate.alias("rate"), F.col("weight").cast("long").alias("rows"))


def calibration_gains(spark, sf_dir):
    """Calibration error of each version before and after maps, on the parts these were not fitted on."""
    return rounded(S.calibration_gains(_labelled_counts(spark, sf_dir)), "before", "after")


def calibrated_estimates(spark, sf_dir):
    """Estimated performance from scores calibrated where that helps."""
    reference, analysis = _prepared(spark, sf_dir)
    maps = S.fit_calibrators(reference, "returned", TIME, "auto")
    found = D.estimated_performance(reference.unionByName(analysis), TIME, calibrators=maps)
    return rounded(found, "cbpe_precision", "cbpe_recall", "cbpe_roc_auc")


def reconstruction_drift(spark, sf_dir):
    reference, analysis = _prepared(spark, sf_dir, require_features=True)
    model = D.ReconstructionDrift(V.RETURNS.feature_columns, TIME).fit(reference)
    found = model.calculate(reference.unionByName(analysis))
    return rounded(found, "reconstruction_error", "lower", "upper")


def monitoring_report(spark, sf_dir):
    reference, analysis = V.scored_cohorts(spark, sf_dir)
    return build_report(reference, analysis, V.RETURNS, source_analysis="batch", reconstruction=False)


def monitored_files(spark, sf_dir):
    """The report from two scored CSV files, as written to its folder and read back."""
    folder = new_workspace(spark, "monitored")
    for name, rows in zip(("reference", "analysis"), V.scored_cohorts(spark, sf_dir)):
        write_csv(rows, f"{folder}/{name}")
    report = monitor_files(
        spark, f"{folder}/reference", V.RETURNS, f"{folder}/analysis", output_folder=folder, reconstruction=False, calibrate="never"
    )
    written = spark.read.csv(f"{folder}/monitoring_summary_batch", header=True)
    return written.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in report.schema])


def monitored_datasets(spark, sf_dir):
    """The same report from two monthly datasets."""
    folder = new_workspace(spark, "monitored")
    for name, rows in zip(("reference", "analysis"), V.scored_cohorts(spark, sf_dir)):
        write_monthly(rows, f"{folder}/{name}", TIME)
    return monitor_datasets(
        spark, f"{folder}/reference", f"{folder}/analysis", V.RETURNS, source_analysis="batch", reconstruction=False, calibrate="never"
    )


def monitoring_report_with_reconstruction(spark, sf_dir):
    reference, analysis = V.scored_cohorts(spark, sf_dir)
    return build_report(reference, analysis, V.RETURNS, source_analysis="batch")


def service_report(spark, sf_dir):
    """Daily report of the service events with failed requests and latency."""
    reference, analysis, errors = V.api_cohorts(spark, sf_dir)
    return build_report(reference, analysis, V.REQUESTS, errors=errors, period="day", reconstruction=False)


QUERIES = {
    "base_summary": base_summary,
    "base_summary_by_day": base_summary_by_day,
    "realized_metrics": realized_metrics,
    "operational_summary": operational_summary,
    "version_overlap": version_overlap,
    "version_restricted_counts": version_restricted_counts,
    "version_filter": version_filter,
    "overlap_guard": overlap_guard,
    "monthly_kpis": monthly_kpis,
    "kpi_overview": kpi_overview,
    "js_drift_categorical": js_drift_categorical,
    "js_drift_continuous": js_drift_continuous,
    "js_bins": js_bins,
    "drift_alert_counts": drift_alert_counts,
    "cbpe_estimates": cbpe_estimates,
    "isotonic_blocks": isotonic_blocks,
    "calibration_gains": calibration_gains,
    "calibrated_estimates": calibrated_estimates,
    "reconstruction_drift": reconstruction_drift,
    "monitoring_report": monitoring_report,
    "monitoring_report_with_reconstruction": monitoring_report_with_reconstruction,
    "monitored_files": monitored_files,
    "monitored_datasets": monitored_datasets,
    "service_report": service_report,
}

# Rank-sum formulation of the ROC AUC: average ranks of the positives.
_REALIZED = """
labelled AS (
  SELECT *, rank() OVER g + (count(*) OVER t - 1) / 2.0::DOUBLE AS avg_rank
  FROM cohorts WHERE returned IS NOT NULL
  WINDOW g AS (PARTITION BY period, model_version, reference_date ORDER BY predicted_probability),
         t AS (PARTITION BY period, model_version, reference_date, predicted_probability)
),
realized AS (
  SELECT period, model_version, reference_date,
         avg(returned::DOUBLE) AS observed_positive_rate,
         coalesce(count(*) FILTER (returned = 1 AND predicted_class = 1)::DOUBLE
                  / nullif(count(*) FILTER (predicted_class = 1), 0), 0) AS realized_precision,
         coalesce(count(*) FILTER (returned = 1 AND predicted_class = 1)::DOUBLE
                  / nullif(count(*) FILTER (returned = 1), 0), 0) AS realized_recall,
         (sum(avg_rank) FILTER (returned = 1)
           - count(*) FILTER (returned = 1) * (count(*) FILTER (returned = 1) + 1) / 2.0::DOUBLE)
         / nullif(count(*) FILTER (returned = 1)::DOUBLE * count(*) FILTER (returned = 0), 0) AS realized_roc_auc
  FROM labelled GROUP BY ALL
)"""

# Soft rank sums: every row is p positives and 1 - p negatives.
_CBPE = """
soft AS (
  SELECT *, sum(1 - p) OVER g - (sum(1 - p) OVER t) / 2 AS below
  FROM (SELECT *, predicted_probability AS p FROM cohorts)
  WINDOW g AS (PARTITION BY period, model_version, reference_date ORDER BY p
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         t AS (PARTITION BY period, model_version, reference_date, p)
),
cbpe AS (
  SELECT period, model_version, reference_date,
         sum(p * predicted_class) / nullif(sum(predicted_class), 0) AS cbpe_precision,
         sum(p * predicted_class) / nullif(sum(p), 0) AS cbpe_recall,
         sum(p * below) / nullif(sum(p) * sum(1 - p), 0) AS cbpe_roc_auc
  FROM soft GROUP BY ALL
)"""

# Isotonic fit by its max-min formula: the largest over starts of the smallest mean over ends. `held` is the part left out, -1 for none.
_FITS = """
parted AS (
  SELECT model_version, predicted_probability AS s, returned AS y,
         ('0x' || substr(md5(concat_ws('|', epoch_us(reference_date), floor(predicted_probability * 1000000000)::BIGINT)), 1, 8))::BIGINT % 3 AS part
  FROM cohorts WHERE period = 'reference' AND returned IS NOT NULL
),
tried AS (
  SELECT model_version, held, s, sum(y)::DOUBLE AS hits, count(*)::DOUBLE AS w
  FROM parted, (SELECT unnest([-1, 0, 1, 2]) AS held) WHERE part <> held GROUP BY ALL
),
cumulative AS (
  SELECT *, sum(hits) OVER o AS h, sum(w) OVER o AS c, row_number() OVER o AS i FROM tried
  WINDOW o AS (PARTITION BY model_version, held ORDER BY s)
),
means AS (
  SELECT a.model_version, a.held, a.i AS a, b.i AS b, (b.h - a.h + a.hits) / (b.c - a.c + a.w) AS mean
  FROM cumulative a JOIN cumulative b ON a.model_version = b.model_version AND a.held = b.held AND b.i >= a.i
),
least AS (
  SELECT model_version, held, a, b, min(mean) OVER (PARTITION BY model_version, held, a ORDER BY b DESC) AS m FROM means
),
fitted AS (
  SELECT c.*, f.fit FROM cumulative c
  JOIN (SELECT model_version, held, b AS i, max(m) AS fit FROM least GROUP BY ALL) f USING (model_version, held, i)
)"""

# A score between two fitted ones lies on the line between them; beyond the outer ones the map is flat.
_GAINS = """
asked AS (SELECT model_version, part AS held, s, sum(y)::DOUBLE AS hits, count(*)::DOUBLE AS w FROM parted GROUP BY ALL),
below AS (SELECT a.*, f.s AS s0, f.fit AS f0 FROM asked a ASOF LEFT JOIN fitted f ON a.model_version = f.model_version AND a.held = f.held AND a.s >= f.s),
both_ AS (SELECT a.*, f.s AS s1, f.fit AS f1 FROM below a ASOF LEFT JOIN fitted f ON a.model_version = f.model_version AND a.held = f.held AND a.s <= f.s),
mapped AS (
  SELECT *, CASE WHEN f0 IS NULL THEN f1 WHEN f1 IS NULL OR s0 = s1 OR f0 = f1 THEN f0 ELSE f0 + (f1 - f0) * (s - s0) / (s1 - s0) END AS t FROM both_
),
errors AS (
  SELECT model_version, 'before' AS kind, greatest(ceil(s * 10), 1) AS bin, sum(s * w - hits) AS gap, sum(w) AS w FROM mapped GROUP BY ALL
  UNION ALL SELECT model_version, 'after', greatest(ceil(t * 10), 1), sum(t * w - hits), sum(w) FROM mapped GROUP BY ALL
),
gains AS (
  SELECT model_version, sum(abs(gap)) FILTER (kind = 'before') / sum(w) FILTER (kind = 'before') AS before,
         sum(abs(gap)) FILTER (kind = 'after') / sum(w) FILTER (kind = 'after') AS after
  FROM errors GROUP BY model_version
),
wanted AS (SELECT f.model_version, f.s, f.fit FROM fitted f JOIN gains USING (model_version) WHERE held = -1 AND after < before),
rows0 AS (SELECT c.*, f.s AS s0, f.fit AS f0 FROM cohorts c ASOF LEFT JOIN wanted f ON c.model_version = f.model_version AND c.predicted_probability >= f.s),
rows1 AS (SELECT c.*, f.s AS s1, f.fit AS f1 FROM rows0 c ASOF LEFT JOIN wanted f ON c.model_version = f.model_version AND c.predicted_probability <= f.s),
calibrated AS (
  SELECT * REPLACE (CASE WHEN f0 IS NULL AND f1 IS NULL THEN predicted_probability WHEN f0 IS NULL THEN f1 WHEN f1 IS NULL OR s0 = s1 OR f0 = f1 THEN f0
                    ELSE f0 + (f1 - f0) * (predicted_probability - s0) / (s1 - s0) END AS predicted_probability)
  FROM rows1
)"""

_CALIBRATED_CBPE = _CBPE.replace("FROM cohorts)", "FROM calibrated)")

_LONG = """
long AS (
  SELECT period, model_version, reference_date, feature, value FROM (
    SELECT period, model_version, reference_date, 'quantity' AS feature, quantity AS value FROM cohorts
    UNION ALL SELECT period, model_version, reference_date, 'discount', discount FROM cohorts
    UNION ALL SELECT period, model_version, reference_date, 'extended_price', extended_price FROM cohorts)
  WHERE value IS NOT NULL
),
moments AS (
  SELECT *, (m3 - 3 * mean * m2 + 2 * mean ** 3) / dev ** 3 AS skew FROM (
    SELECT model_version, feature, count(*) AS rows, count(DISTINCT value) AS levels,
           min(value) AS low, max(value) AS high, avg(value) AS mean, stddev_pop(value) AS dev,
           avg(value ** 2) AS m2, avg(value ** 3) AS m3
    FROM long WHERE period = 'reference' GROUP BY model_version, feature)
),
ranges AS (
  SELECT model_version, feature, rows, levels, low, high,
         CAST(ceil(1 + log2(rows) + log2(1 + abs(skew)
              / sqrt(6 * (rows - 2) / ((rows + 1.0::DOUBLE) * (rows + 3))))) AS INTEGER) AS bins,
         levels <= 50 AND levels / rows::DOUBLE <= 0.1 AS as_category
  FROM moments
)"""

_JS = """
reference_share AS (
  SELECT model_version, feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY model_version, feature) AS p
  FROM binned WHERE period = 'reference' GROUP BY model_version, feature, bin
),
chunk_share AS (
  SELECT period, model_version, reference_date, feature, bin,
         count(*) / sum(count(*)) OVER (PARTITION BY period, model_version, reference_date, feature) AS q
  FROM binned GROUP BY period, model_version, reference_date, feature, bin
),
grid AS (
  SELECT c.period, c.model_version, c.reference_date, r.feature, r.bin, r.p
  FROM (SELECT DISTINCT period, model_version, reference_date, feature FROM chunk_share) c
  JOIN reference_share r ON r.model_version = c.model_version AND r.feature = c.feature
),
pairs AS (
  SELECT period, model_version, reference_date, feature, coalesce(p, 0) AS p, coalesce(q, 0) AS q
  FROM grid FULL JOIN chunk_share USING (period, model_version, reference_date, feature, bin)
),
js AS (
  SELECT period, model_version, reference_date, feature,
         sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
                         + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / (2 * ln(2)), 0)) AS distance
  FROM pairs GROUP BY ALL
)"""

_BIN_NUMBERS = """
binned AS (
  SELECT l.period, l.model_version, l.reference_date, l.feature,
         CASE WHEN as_category THEN value
              WHEN value BETWEEN low AND high THEN least(floor((value - low) / (high - low) * bins), bins - 1)
              ELSE -1 END AS bin
  FROM long l JOIN ranges r ON r.model_version = l.model_version AND r.feature = l.feature
)"""

_BIN_WORDS = """
binned AS (
  SELECT period, model_version, reference_date, 'line_status' AS feature, line_status AS bin
  FROM cohorts WHERE line_status IS NOT NULL
)"""

_BIN_ALL = _BIN_NUMBERS.replace(
    "r.feature = l.feature\n)",
    """r.feature = l.feature
  UNION ALL
  SELECT period, model_version, reference_date, 'line_status', CASE line_status WHEN 'F' THEN 1 ELSE 2 END
  FROM cohorts WHERE line_status IS NOT NULL
)""",
)

_BASE = """
base AS (
  SELECT source, period, model_version, reference_date, count(*) AS prediction_count,
         avg(predicted_probability) AS avg_predicted_probability,
         avg(predicted_class::DOUBLE) AS predicted_positive_rate
  FROM cohorts GROUP BY ALL
)"""

_ROUND6 = "round(round({0}, 10), 6) AS {0}"


def _six(*columns: str) -> str:
    return ", ".join(_ROUND6.format(c) for c in columns)


def _four(*columns: str) -> str:
    return ", ".join(f"round_even(round({c}, 10) * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE AS {c}" for c in columns)


_API_COHORTS = """
cohorts AS (
  SELECT CASE WHEN period = 'reference' THEN 'batch' ELSE 'api' END AS source, period, model_version,
         reference_date, predicted_probability, predicted_class,
         CASE WHEN period = 'reference' THEN converted END AS returned, amount, k, channel
  FROM api_days WHERE event = 'prediction'
)"""

_API_SERVICE = """
service AS (
  SELECT period, model_version, reference_date,
         round(quantile_cont(latency_ms, 0.5) FILTER (event = 'prediction'), 6) AS prediction_latency_p50_ms,
         round(quantile_cont(latency_ms, 0.95) FILTER (event = 'prediction'), 6) AS prediction_latency_p95_ms,
         round(quantile_cont(latency_ms, 0.5) FILTER (event <> 'prediction'), 6) AS api_error_latency_p50_ms,
         round(quantile_cont(latency_ms, 0.95) FILTER (event <> 'prediction'), 6) AS api_error_latency_p95_ms,
         count(*) AS api_request_count,
         round(count(*) FILTER (event <> 'prediction') / count(*)::DOUBLE, 6) AS api_error_rate
  FROM api_days WHERE period = 'analysis' GROUP BY ALL
)"""

_API_LONG = """
population AS (
  SELECT period, model_version, reference_date, amount, k, channel
  FROM api_days WHERE event = 'prediction' OR period = 'analysis'
),
long AS (
  SELECT period, model_version, reference_date, 'amount' AS feature, amount AS value FROM population
  UNION ALL SELECT period, model_version, reference_date, 'k', k::DOUBLE FROM population
),""" + _LONG.split("),", 1)[1].replace(
    "CAST(ceil(1 + log2(rows)", "CAST(ceil(least(CASE WHEN feature = 'k' THEN high - low ELSE 1e9 END, 1 + log2(rows)"
).replace("(rows + 3))))) AS INTEGER)", "(rows + 3)))))) AS INTEGER)")

_API_BINS = _BIN_NUMBERS.replace(
    "r.feature = l.feature\n)",
    """r.feature = l.feature
  UNION ALL
  SELECT period, model_version, reference_date, 'channel', channel::DOUBLE FROM population
)""",
)

ORACLES = {
    "base_summary": with_views(
        COHORTS, _BASE,
        query=f"SELECT source, period, model_version, reference_date, prediction_count, {_six('avg_predicted_probability', 'predicted_positive_rate')} FROM base",
    ),
    "base_summary_by_day": with_views(
        API, _API_COHORTS, _BASE,
        query=f"SELECT source, period, model_version, reference_date, prediction_count, {_six('avg_predicted_probability', 'predicted_positive_rate')} FROM base",
    ),
    "realized_metrics": with_views(
        COHORTS, _REALIZED,
        query=f"SELECT period, model_version, reference_date, {_six('observed_positive_rate', 'realized_precision', 'realized_recall', 'realized_roc_auc')} FROM realized",
    ),
    "operational_summary": with_views(API, _API_SERVICE, query="SELECT * FROM service"),
    "version_overlap": with_views(
        COHORTS,
        query="""
SELECT model_version, 'common' AS presence FROM (
  SELECT model_version FROM cohorts WHERE period = 'reference'
  INTERSECT SELECT model_version FROM cohorts WHERE period = 'analysis' AND model_version <> 2)
UNION ALL SELECT model_version, 'reference_only' FROM (
  SELECT model_version FROM cohorts WHERE period = 'reference'
  EXCEPT SELECT model_version FROM cohorts WHERE period = 'analysis' AND model_version <> 2)""",
    ),
    "version_restricted_counts": with_views(
        COHORTS,
        query="SELECT period, model_version, count(*) AS rows FROM cohorts WHERE model_version = 1 GROUP BY ALL",
    ),
    "version_filter": with_views(
        COHORTS,
        query="SELECT period, model_version, count(*) AS rows FROM cohorts WHERE model_version = 2 GROUP BY ALL",
    ),
    "overlap_guard": with_views(
        COHORTS,
        query="""
SELECT (SELECT max(reference_date) FROM cohorts WHERE period = 'reference') AS reference_end,
       (SELECT min(reference_date) FROM cohorts WHERE period = 'analysis') AS monitored_start,
       (SELECT min(reference_date) FROM cohorts WHERE period = 'analysis')
         <= (SELECT max(reference_date) FROM cohorts WHERE period = 'reference') AS overlaps""",
    ),
    "monthly_kpis": with_views(
        COHORTS,
        query="""
SELECT reference_date, round(avg(returned::DOUBLE), 6) AS mean_target,
       round(avg(predicted_probability), 6) AS mean_probability, round(avg(predicted_class::DOUBLE), 6) AS mean_class
FROM cohorts GROUP BY reference_date""",
    ),
    "kpi_overview": with_views(
        COHORTS, _CBPE, _LONG, _BIN_ALL, _JS,
        query=f"""
SELECT reference_date, {_six('mean_target', 'mean_probability', 'mean_class', 'cbpe_roc_auc')}, univariate_drift_alert_count
FROM (SELECT reference_date, avg(returned::DOUBLE) AS mean_target, avg(predicted_probability) AS mean_probability,
             avg(predicted_class::DOUBLE) AS mean_class FROM cohorts WHERE model_version = 1 GROUP BY reference_date)
FULL JOIN (SELECT reference_date, cbpe_roc_auc FROM cbpe WHERE model_version = 1) USING (reference_date)
FULL JOIN (SELECT reference_date, count(*) FILTER (distance > 0.1) AS univariate_drift_alert_count
           FROM js WHERE model_version = 1 GROUP BY reference_date) USING (reference_date)""",
    ),
    "js_drift_categorical": with_views(
        COHORTS, _BIN_WORDS, _JS,
        query="SELECT period, model_version, reference_date, feature, round(distance, 6) AS distance, distance > 0.1 AS alert FROM js",
    ),
    "js_drift_continuous": with_views(
        COHORTS, _LONG, _BIN_NUMBERS, _JS,
        query="SELECT period, model_version, reference_date, feature, round(distance, 6) AS distance, distance > 0.1 AS alert FROM js",
    ),
    "js_bins": with_views(
        COHORTS, _LONG,
        query="SELECT model_version, feature, low, high, bins, as_category FROM ranges",
    ),
    "drift_alert_counts": with_views(
        COHORTS, _LONG, _BIN_ALL, _JS,
        query="SELECT period, model_version, reference_date, count(*) FILTER (distance > 0.1) AS univariate_drift_alert_count FROM js GROUP BY ALL",
    ),
    "cbpe_estimates": with_views(
        COHORTS, _CBPE,
        query=f"SELECT period, model_version, reference_date, {_six('cbpe_precision', 'cbpe_recall', 'cbpe_roc_auc')} FROM cbpe",
    ),
    "isotonic_blocks": with_views(
        COHORTS, _FITS,
        query="""
SELECT model_version, min(s) AS low, max(s) AS high, round(round(any_value(fit), 10), 6) AS rate, sum(w)::BIGINT AS rows
FROM fitted WHERE held = -1 GROUP BY model_version, round(fit, 12)""",
    ),
    "calibration_gains": with_views(COHORTS, _FITS, _GAINS, query=f"SELECT model_version, {_six('before', 'after')} FROM gains"),
    "calibrated_estimates": with_views(
        COHORTS, _FITS, _GAINS, _CALIBRATED_CBPE,
        query=f"SELECT period, model_version, reference_date, {_six('cbpe_precision', 'cbpe_recall', 'cbpe_roc_auc')} FROM cbpe",
    ),
    **{
        name: with_views(
            COHORTS, _BASE, _REALIZED, *estimates, _LONG, _BIN_ALL, _JS,
            query=f"""
SELECT source, period, model_version, reference_date, prediction_count,
       {_four('avg_predicted_probability', 'predicted_positive_rate', 'observed_positive_rate', 'realized_precision', 'realized_recall', 'realized_roc_auc', 'cbpe_precision', 'cbpe_recall', 'cbpe_roc_auc')},
       univariate_drift_alert_count
FROM base LEFT JOIN realized USING (period, model_version, reference_date)
LEFT JOIN cbpe USING (period, model_version, reference_date)
LEFT JOIN (SELECT period, model_version, reference_date,
                  count(*) FILTER (distance > 0.1) AS univariate_drift_alert_count FROM js GROUP BY ALL)
  USING (period, model_version, reference_date)""",
        )
        for name, estimates in (
            ("monitoring_report", (_FITS, _GAINS, _CALIBRATED_CBPE)),
            ("monitored_files", (_CBPE,)),
            ("monitored_datasets", (_CBPE,)),
        )
    },
    "service_report": with_views(
        API, _API_COHORTS, _BASE, _REALIZED, _FITS, _GAINS, _CALIBRATED_CBPE, _API_SERVICE, _API_LONG, _API_BINS, _JS,
        query=f"""
SELECT source, period, model_version, reference_date, prediction_count,
       {_four('avg_predicted_probability', 'predicted_positive_rate', 'observed_positive_rate', 'realized_precision', 'realized_recall', 'realized_roc_auc', 'cbpe_precision', 'cbpe_recall', 'cbpe_roc_auc')},
       univariate_drift_alert_count,
       {_four('prediction_latency_p50_ms', 'prediction_latency_p95_ms', 'api_error_latency_p50_ms', 'api_error_latency_p95_ms')},
       api_request_count, {_four('api_error_rate')}
FROM base LEFT JOIN realized USING (period, model_version, reference_date)
LEFT JOIN cbpe USING (period, model_version, reference_date)
LEFT JOIN (SELECT period, model_version, reference_date,
                  count(*) FILTER (distance > 0.1) AS univariate_drift_alert_count FROM js GROUP BY ALL)
  USING (period, model_version, reference_date)
FULL JOIN service USING (period, model_version, reference_date)""",
    ),
}
