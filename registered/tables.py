"""Contracts, features, profiles, samples and folds over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.functions.features import ENGINEERED, engineer
from cohorta.operators import profile as P
from cohorta.operators import sampling as S
from cohorta.operators import validation as X
from cohorta.operators.cohorts import union_cohorts
from cohorta.plans import views as V
from registered.derived import API, CUSTOMERS, SCORED, with_views
from registered.metrics import rounded

NUMERIC = ["age", "tenure", "usage_frequency", "support_calls", "payment_delay", "last_interaction", "total_spend"]
TEXT = ["gender", "subscription_type", "contract_length"]


def _customers(spark, sf_dir):
    return V.customers(spark, sf_dir)


def _halves(spark, sf_dir):
    """Earlier and later customers as two cohorts."""
    rows = _customers(spark, sf_dir)
    cut = F.lit("2001-01-01").cast("timestamp_ntz")
    return rows.where(F.col("reference_date") < cut), rows.where(F.col("reference_date") >= cut)


def contract_violations(spark, sf_dir):
    return X.violations(_customers(spark, sf_dir), CHURN)


def quarantine_valid(spark, sf_dir):
    valid, _ = X.quarantine(_customers(spark, sf_dir), CHURN)
    return valid


def quarantine_reasons(spark, sf_dir):
    _, invalid = X.quarantine(_customers(spark, sf_dir), CHURN)
    return invalid.select("customerid", F.concat_ws(",", "reasons").alias("reasons"))


def validated_rows(spark, sf_dir):
    return X.validate(V.valid_customers(spark, sf_dir), CHURN)


def engineered_features(spark, sf_dir):
    rows = _customers(spark, sf_dir)
    built = engineer(X.select_features(rows, ["customerid", *CHURN.feature_columns]))
    return rounded(built.select("customerid", *ENGINEERED))


def null_profile(spark, sf_dir):
    early, late = _halves(spark, sf_dir)
    hidden = early.withColumn("age", F.when(F.col("customerid") % 7 != 0, F.col("age")))
    return P.null_profile(hidden, late, ("training", "inference"))


def profile_numeric(spark, sf_dir):
    return rounded(P.numeric_profile(_customers(spark, sf_dir), NUMERIC))


def profile_string(spark, sf_dir):
    return P.string_profile(_customers(spark, sf_dir), TEXT)


def correlation_long(spark, sf_dir):
    return rounded(P.correlations(_customers(spark, sf_dir), [*NUMERIC, "churn"]))


def category_shares(spark, sf_dir):
    return rounded(P.category_shares(_customers(spark, sf_dir), TEXT))


def category_share_compare(spark, sf_dir):
    early, late = _halves(spark, sf_dir)
    return rounded(P.compare_shares(early, late, ["contract_length"], ("training", "inference")))


def cohort_key_overlap(spark, sf_dir):
    rows = _customers(spark, sf_dir)
    shifted = rows.withColumns(
        {"customerid": F.col("customerid") + 5, "age": F.col("age") + F.col("customerid") % 2}
    )
    return P.key_overlap(rows, shifted, "customerid", [*NUMERIC, *TEXT])


def incidence_by_category(spark, sf_dir):
    return rounded(P.incidence(_customers(spark, sf_dir), ["contract_length"], "churn"))


def mean_by_two_categories(spark, sf_dir):
    return rounded(P.mean_by(_customers(spark, sf_dir), ["gender", "subscription_type"], "age"))


def incidence_fixed_bins(spark, sf_dir):
    rows = _customers(spark, sf_dir).withColumn("spend_level", F.col("customerid") % 1200)
    return rounded(P.incidence_fixed_bins(rows, "spend_level", "churn", 100, 1000, 100))


def incidence_deciles(spark, sf_dir):
    built = engineer(_customers(spark, sf_dir))
    return rounded(P.incidence_quantiles(built, "avg_s_calls_per_year", "churn", 10))


def score_histogram(spark, sf_dir):
    return P.histogram(V.scored(spark, sf_dir), "predicted_probability", 0, 1, 20, ["returned"])


def balanced_assignment(spark, sf_dir):
    rows = V.table(spark, sf_dir, "events").select("event_id")
    return S.assign_balanced(rows, ["A", "B", "C", "D", "E", "F", "G"], "part", "event_id")


def seeded_sample(spark, sf_dir):
    return S.seeded_sample(V.table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 100)


def stratified_split(spark, sf_dir):
    return S.stratified_split(
        _customers(spark, sf_dir).select("customerid", "churn"), "customerid", "churn"
    )


def month_spine(spark, sf_dir):
    return S.period_spine(V.table(spark, sf_dir, "orders"), "o_orderdate")


def union_of_cohorts(spark, sf_dir):
    """Rows and known labels after a union of cohorts whose columns differ."""
    reference, analysis, errors = V.api_cohorts(spark, sf_dir)
    whole = union_cohorts(reference, analysis, errors)
    return whole.groupBy("event", "model_version").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("converted").alias("labelled"),
        F.count("predicted_class").alias("scored_rows"),
    )


QUERIES = {
    "contract_violations": contract_violations,
    "quarantine_valid": quarantine_valid,
    "quarantine_reasons": quarantine_reasons,
    "validated_rows": validated_rows,
    "engineered_features": engineered_features,
    "null_profile": null_profile,
    "profile_numeric": profile_numeric,
    "profile_string": profile_string,
    "correlation_long": correlation_long,
    "category_shares": category_shares,
    "category_share_compare": category_share_compare,
    "cohort_key_overlap": cohort_key_overlap,
    "incidence_by_category": incidence_by_category,
    "mean_by_two_categories": mean_by_two_categories,
    "incidence_fixed_bins": incidence_fixed_bins,
    "incidence_deciles": incidence_deciles,
    "score_histogram": score_histogram,
    "balanced_assignment": balanced_assignment,
    "seeded_sample": seeded_sample,
    "stratified_split": stratified_split,
    "month_spine": month_spine,
    "union_of_cohorts": union_of_cohorts,
}


def _r(expression: str, name: str) -> str:
    return f"round(round({expression}, 10), 6) AS {name}"


def _rule_rows() -> str:
    """One row per column rule, written out by hand for the churn contract."""
    known = {
        "customerid": None,
        "age": "age < 18 OR age > 115",
        "tenure": "tenure < 0",
        "usage_frequency": "usage_frequency < 0",
        "support_calls": "support_calls < 0",
        "payment_delay": "payment_delay < 0",
        "last_interaction": "last_interaction < 0",
        "total_spend": "total_spend < 0",
        "gender": "gender NOT IN ('Female', 'Male')",
        "subscription_type": "subscription_type NOT IN ('Basic', 'Standard', 'Premium')",
        "contract_length": "contract_length NOT IN ('Annual', 'Monthly', 'Quarterly')",
        "churn": "churn NOT IN (0, 1)",
        "reference_date": None,
    }
    parts = []
    for column, broken in known.items():
        parts.append(f"SELECT '{column}' AS column_name, 'missing_value' AS rule, count(*) FILTER ({column} IS NULL) AS failed_rows FROM customers")
        parts.append(f"SELECT '{column}', 'wrong_type', 0 FROM (SELECT 1)")
        if broken:
            label = "not_allowed" if "NOT IN" in broken else "out_of_range"
            parts.append(f"SELECT '{column}', '{label}', count(*) FILTER ({broken}) FROM customers")
    return " UNION ALL ".join(parts)


_HALVES = """
early AS (SELECT * FROM customers WHERE reference_date < TIMESTAMP '2001-01-01'),
late AS (SELECT * FROM customers WHERE reference_date >= TIMESTAMP '2001-01-01')"""

_FEATURES = """
features AS (
  SELECT *, CASE contract_length WHEN 'Monthly' THEN 1 WHEN 'Quarterly' THEN 4 WHEN 'Annual' THEN 12 ELSE 0 END AS contract_commitment,
         CASE WHEN tenure = 0 THEN 0 ELSE support_calls / (tenure / 12.0::DOUBLE) END AS avg_s_calls_per_year
  FROM customers
)"""


def _numeric_profile() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, {_r(f'avg({c})', 'mean')}, {_r(f'stddev_samp({c})', 'std')},
min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, {_r(f'quantile_cont({c}::DOUBLE, 0.25)', 'p25')},
{_r(f'quantile_cont({c}::DOUBLE, 0.5)', 'p50')}, {_r(f'quantile_cont({c}::DOUBLE, 0.75)', 'p75')} FROM customers"""
        for c in NUMERIC
    )


def _string_profile() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, (SELECT count({c}) FROM customers) AS count,
(SELECT count(DISTINCT {c}) FROM customers) AS "unique", n AS freq, {c} AS top
FROM (SELECT {c}, count(*) AS n FROM customers GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""
        for c in TEXT
    )


def _correlations() -> str:
    columns = [*NUMERIC, "churn"]
    same = [f"SELECT '{c}' AS left_column, '{c}' AS right_column, 1.0::DOUBLE AS correlation" for c in columns]
    other = [
        f"SELECT '{a}', '{b}', {_r(f'corr({a}, {b})', 'correlation')} FROM customers"
        for a in columns
        for b in columns
        if a != b
    ]
    return " UNION ALL ".join([*same, *other])


def _overlap() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS matched_rows, count(*) FILTER (a.{c} = b.{c}) AS equal_values "
        "FROM customers a JOIN shifted b ON a.customerid = b.customerid"
        for c in [*NUMERIC, *TEXT]
    )


def _nulls() -> str:
    columns = ["customerid", *NUMERIC, *TEXT, "churn", "reference_date"]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT count(*) FILTER ({'customerid % 7 = 0' if c == 'age' else f'{c} IS NULL'}) FROM early) AS training, "
        f"(SELECT count(*) FILTER ({c} IS NULL) FROM late) AS inference"
        for c in columns
    )


_CALENDAR = "(SELECT unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2010-01-01', INTERVAL 1 MONTH)) AS m)"

ORACLES = {
    "contract_violations": with_views(CUSTOMERS, query=_rule_rows()),
    "quarantine_valid": with_views(CUSTOMERS, query="SELECT * FROM valid_customers"),
    "quarantine_reasons": with_views(
        CUSTOMERS,
        query="""
SELECT customerid, concat_ws(',', CASE WHEN contract_length = 'Weekly' THEN 'contract_length:not_allowed' END,
       CASE WHEN reference_date IS NULL THEN 'reference_date:missing_value' END) AS reasons
FROM customers WHERE contract_length = 'Weekly' OR reference_date IS NULL""",
    ),
    "validated_rows": with_views(CUSTOMERS, query="SELECT * FROM valid_customers"),
    "engineered_features": with_views(
        CUSTOMERS, _FEATURES,
        query=f"""
SELECT customerid, contract_commitment,
       {_r('coalesce(tenure::DOUBLE / nullif(contract_commitment, 0), 0)', 'tenure_rel2_commitment')},
       {_r('usage_frequency / 30.0::DOUBLE * (30 - last_interaction)', 'engagement')},
       {_r('CASE WHEN tenure = 0 THEN 0 ELSE total_spend / (tenure / 12.0::DOUBLE) END', 'avg_spend_per_year')},
       {_r('avg_s_calls_per_year', 'avg_s_calls_per_year')},
       (payment_delay > 15)::INTEGER AS late_payer, (last_interaction > 15)::INTEGER AS inactive_customer
FROM features""",
    ),
    "null_profile": with_views(CUSTOMERS, _HALVES, query=_nulls()),
    "profile_numeric": with_views(CUSTOMERS, query=_numeric_profile()),
    "profile_string": with_views(CUSTOMERS, query=_string_profile()),
    "correlation_long": with_views(CUSTOMERS, query=_correlations()),
    "category_shares": with_views(
        CUSTOMERS,
        query=f"""SELECT gender, subscription_type, contract_length,
{_r('count(*) / (SELECT count(*) FROM customers)::DOUBLE', 'share')} FROM customers GROUP BY ALL""",
    ),
    "category_share_compare": with_views(
        CUSTOMERS, _HALVES,
        query=f"""
SELECT contract_length, {_r('a', 'training')}, {_r('b', 'inference')}
FROM (SELECT contract_length, count(*) / (SELECT count(*) FROM early)::DOUBLE AS a FROM early GROUP BY ALL)
FULL JOIN (SELECT contract_length, count(*) / (SELECT count(*) FROM late)::DOUBLE AS b FROM late GROUP BY ALL)
USING (contract_length)""",
    ),
    "cohort_key_overlap": with_views(
        CUSTOMERS,
        "shifted AS (SELECT * REPLACE (customerid + 5 AS customerid, age + customerid % 2 AS age) FROM customers)",
        query=_overlap(),
    ),
    "incidence_by_category": with_views(
        CUSTOMERS,
        query=f"SELECT contract_length, count(churn) AS rows, {_r('avg(churn)', 'incidence')} FROM customers GROUP BY ALL",
    ),
    "mean_by_two_categories": with_views(
        CUSTOMERS,
        query=f"SELECT gender, subscription_type, {_r('avg(age)', 'mean_age')} FROM customers GROUP BY ALL",
    ),
    "incidence_fixed_bins": with_views(
        CUSTOMERS,
        query=f"""
SELECT (100 + CASE WHEN v = 100 THEN 100 ELSE ((v - 100 + 99) // 100) * 100 END)::DOUBLE AS bin_high,
       count(churn) AS rows, {_r('avg(churn)', 'incidence')}
FROM (SELECT customerid % 1200 AS v, churn FROM customers) WHERE v BETWEEN 100 AND 1000 GROUP BY ALL""",
    ),
    "incidence_deciles": with_views(
        CUSTOMERS, _FEATURES,
        "borders AS (SELECT list_sort(list_distinct(quantile_cont(avg_s_calls_per_year, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS b FROM features)",
        query=f"""
SELECT bin, count(churn) AS rows, {_r('avg(churn)', 'incidence')}, {_r('any_value(b[bin + 1])', 'bin_high')}
FROM (SELECT churn, b, (1 + len(list_filter(b[2:len(b) - 1], lambda e: e < avg_s_calls_per_year)))::INTEGER AS bin FROM features, borders)
GROUP BY bin""",
    ),
    "score_histogram": with_views(
        SCORED,
        query="""
SELECT returned, CAST(least(floor(predicted_probability * 20), 19) AS INTEGER) AS bin, count(*) AS rows
FROM scored GROUP BY ALL""",
    ),
    "balanced_assignment": """
WITH ordered AS (
  SELECT event_id, row_number() OVER (ORDER BY md5('42|' || event_id), event_id) - 1 AS pos, count(*) OVER () AS n FROM events)
SELECT event_id, ['A', 'B', 'C', 'D', 'E', 'F', 'G'][CAST(CASE WHEN pos < (n % 7) * (n // 7 + 1) THEN pos // (n // 7 + 1)
       ELSE n % 7 + (pos - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) + 1] AS part
FROM ordered""",
    "seeded_sample": "SELECT event_id, value FROM events ORDER BY md5('42|' || event_id), event_id LIMIT 100",
    "stratified_split": with_views(
        CUSTOMERS,
        query="""
SELECT customerid, churn, CASE WHEN r <= ceil(0.3::DOUBLE * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT customerid, churn, count(*) OVER (PARTITION BY churn) AS n,
             row_number() OVER (PARTITION BY churn ORDER BY md5('42|' || customerid), customerid) AS r FROM customers)""",
    ),
    "month_spine": f"""
SELECT m AS period_start FROM {_CALENDAR}
WHERE m BETWEEN (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AND (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)""",
    "union_of_cohorts": with_views(
        API,
        query="""
SELECT event, model_version, count(*) AS rows,
       count(*) FILTER (event = 'prediction' AND period = 'reference') AS labelled,
       count(*) FILTER (event = 'prediction') AS scored_rows
FROM api_days WHERE event = 'prediction' OR period = 'analysis' GROUP BY ALL""",
    ),
}
