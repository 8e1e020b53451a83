"""Preprocessing, folds, fitting, scoring over the derived customer table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.functions.features import rule_classifier
from cohorta.learning.calibration import fit_with_calibration
from cohorta.learning.categories import number_labels
from cohorta.learning.classifiers import MajorityClassifier
from cohorta.learning.folds import fold_table, temporal_folds
from cohorta.learning.pipelines import fit_pipeline
from cohorta.learning.settings import Fitting, JobPlan, Search
from cohorta.learning.stages import Imputer, PopulationScaler
from cohorta.learning.tuning import optimize
from cohorta.operators.sampling import seeded_sample
from cohorta.plans import views as V
from cohorta.plans.scoring import RuleScorer, observe_mean_probability, sample_scoring_run, score_batch
from cohorta.plans.training import train_model
from cohorta.session import new_workspace
from cohorta.sources.delimited import read_run_files
from cohorta.sources.splits import with_split
from registered.derived import CUSTOMERS, with_views
from registered.metrics import rounded

TIME, SPLIT = "reference_date", "2001-01-01"


def _with_gaps(spark, sf_dir):
    """Customers with numbers and words missing by key."""
    key = F.col("customerid")
    return V.customers(spark, sf_dir).select(
        "customerid",
        F.when(key % 5 != 0, F.col("age")).alias("age"),
        F.when(key % 7 != 0, F.col("total_spend")).alias("total_spend"),
        F.when(key % 3 != 0, F.col("gender")).alias("gender"),
    )


def imputed_scaled(spark, sf_dir):
    rows = _with_gaps(spark, sf_dir)
    filled = Imputer(["age", "total_spend", "gender"]).fit(rows).transform(rows)
    scaled = PopulationScaler(["age", "total_spend"]).fit(filled).transform(filled)
    return rounded(scaled)


def majority_baseline(spark, sf_dir):
    rows = V.customers(spark, sf_dir).select("customerid", "churn")
    model = MajorityClassifier(labelCol="churn").fit(rows)
    return model.transform(rows).select("customerid", "prediction")


def temporal_fold_rows(spark, sf_dir):
    """Rows, first and last moment per fold and role."""
    rows = V.valid_customers(spark, sf_dir).select("customerid", TIME, "churn")
    folds = temporal_folds(rows, "churn", TIME, 3)
    return (
        fold_table(rows, TIME, folds)
        .groupBy("fold", "role")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(TIME).alias("first_time"),
            F.max(TIME).alias("last_time"),
        )
    )


def batch_score_rule(spark, sf_dir):
    scored = score_batch(
        V.valid_customers(spark, sf_dir), CHURN, RuleScorer(rule_classifier), 0.5, 3
    )
    return scored.select(
        "customerid", "predicted_probability", "predicted_class", "threshold", "model_version"
    )


def _sides(spark, sf_dir):
    rows = with_split(V.valid_customers(spark, sf_dir), TIME, SPLIT)
    return (
        rows.where("split = 'train'").drop("split"),
        rows.where("split = 'test'").drop("split"),
    )


def _train(spark, sf_dir, alias, method="none", **params):
    train, test = _sides(spark, sf_dir)
    result = train_model(
        CHURN, JobPlan(Fitting(alias, params)), train, test, calibration_method=method
    )
    return rounded(result.model.score(test).select("customerid", "churn", "predicted_probability"))


def train_lr_score(spark, sf_dir):
    return _train(spark, sf_dir, "lr")


def train_nb_score(spark, sf_dir):
    return _train(spark, sf_dir, "nb")


def train_nb_table_score(spark, sf_dir):
    """Naive Bayes with the categories kept in a table: the same scores."""
    train, test = _sides(spark, sf_dir)
    fitted, _ = fit_pipeline(CHURN, "nb", {}, train, categories="table")
    return rounded(fitted.score(test).select("customerid", "churn", "predicted_probability"))


def category_numbers(spark, sf_dir):
    """Every part name, brand and type, numbered in order."""
    columns = ["p_name", "p_brand", "p_type"]
    return number_labels(V.table(spark, sf_dir, "part").select(*columns), columns)


def train_rf_score(spark, sf_dir):
    return _train(spark, sf_dir, "rf", n_estimators=20, max_depth=6)


def train_et_score(spark, sf_dir):
    return _train(spark, sf_dir, "et")


def train_hgb_score(spark, sf_dir):
    return _train(spark, sf_dir, "hgb")


def train_hgb_stumps(spark, sf_dir):
    """Two trees of two leaves with a leaf penalty; a bin for every value, so SQL can try all cuts."""
    return _train(spark, sf_dir, "hgb", max_iter=2, max_leaf_nodes=2, l2_regularization=1.5, learning_rate=0.4, max_bins=60_000)


def train_lda_score(spark, sf_dir):
    return _train(spark, sf_dir, "lda")


def train_qda_score(spark, sf_dir):
    return _train(spark, sf_dir, "qda")


def train_ada_score(spark, sf_dir):
    return _train(spark, sf_dir, "ada", n_estimators=5)


def train_knn_score(spark, sf_dir):
    return _train(spark, sf_dir, "knn", n_neighbors=7)


def calibrated_sigmoid_score(spark, sf_dir):
    return _train(spark, sf_dir, "lsvc", "sigmoid")


def calibrated_isotonic_score(spark, sf_dir):
    return _train(spark, sf_dir, "lr", "isotonic")


def calibrated_svc_score(spark, sf_dir):
    return _train(spark, sf_dir, "svc", "sigmoid")


def feature_importance(spark, sf_dir):
    """Random-forest importances by feature name, strongest first."""
    train, _ = _sides(spark, sf_dir)
    fitted, _ = fit_with_calibration(CHURN, "rf", {"n_estimators": 20, "max_depth": 6}, train)
    weights = fitted.model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(fitted.names_out, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return rounded(table.orderBy(F.desc("importance"), "feature"))


def tuned_parameters(spark, sf_dir):
    train, _ = _sides(spark, sf_dir)
    config = JobPlan(Fitting("nb"), Search(trials=2, folds=2))
    best = optimize(CHURN, config, train)
    rows = [(name, float(value), best.best_score) for name, value in best.best_params.items()]
    return rounded(spark.createDataFrame(rows, "parameter string, chosen double, score double"), 12)


def sample_scoring(spark, sf_dir):
    """A reproducible sample of the customers scored with the rule benchmark."""
    sample = seeded_sample(V.customers(spark, sf_dir), "customerid", 200, 7)
    return RuleScorer(rule_classifier).score(sample).select("customerid", "predicted_probability")


def sample_run_file(spark, sf_dir):
    """The sample scored and written as a numbered run, and the folder of runs read again."""
    folder = new_workspace(spark, "runs")
    sample_scoring_run(
        V.valid_customers(spark, sf_dir), CHURN, RuleScorer(rule_classifier), 0.5, 3, "customerid", 200, 7, folder, 12, "2026-01-31"
    )
    return read_run_files(spark, folder).select(
        F.col("customerid").cast("bigint").alias("customerid"),
        F.col("predicted_probability").cast("double").alias("predicted_probability"),
        F.col("predicted_class").cast("int").alias("predicted_class"),
        F.col("model_version").cast("int").alias("model_version"),
        "run_id",
    )


def mean_probability(spark, sf_dir):
    """Row count and mean probability as observed while scored rows are written."""
    scored = RuleScorer(rule_classifier).score(V.valid_customers(spark, sf_dir))
    counted, watch = observe_mean_probability(scored)
    counted.write.parquet(new_workspace(spark, "scored"))
    row = (watch.get["rows"], watch.get["mean_probability"])
    return rounded(spark.createDataFrame([row], "rows bigint, mean_probability double"))


QUERIES = {
    "imputed_scaled": imputed_scaled,
    "majority_baseline": majority_baseline,
    "temporal_folds": temporal_fold_rows,
    "batch_score_rule": batch_score_rule,
    "train_lr_score": train_lr_score,
    "train_nb_score": train_nb_score,
    "train_nb_table_score": train_nb_table_score,
    "category_numbers": category_numbers,
    "train_rf_score": train_rf_score,
    "train_et_score": train_et_score,
    "train_hgb_score": train_hgb_score,
    "train_hgb_stumps": train_hgb_stumps,
    "train_lda_score": train_lda_score,
    "train_qda_score": train_qda_score,
    "train_ada_score": train_ada_score,
    "train_knn_score": train_knn_score,
    "calibrated_sigmoid_score": calibrated_sigmoid_score,
    "calibrated_isotonic_score": calibrated_isotonic_score,
    "calibrated_svc_score": calibrated_svc_score,
    "feature_importance": feature_importance,
    "tuned_parameters": tuned_parameters,
    "sample_scoring": sample_scoring,
    "sample_run_file": sample_run_file,
    "mean_probability": mean_probability,
}

_RULE = "CASE WHEN age > 50 OR support_calls >= 6 OR payment_delay > 20 OR total_spend <= 500 OR contract_length = 'Monthly' THEN 1 ELSE 0 END"

# Gaussian naive Bayes over the long (customer, feature, value) form of the feature matrix.
_BAYES = """
built AS (
  SELECT customerid, churn, reference_date < TIMESTAMP '2001-01-01' AS train, age::DOUBLE AS f1, tenure::DOUBLE AS f2,
         usage_frequency::DOUBLE AS f3, support_calls::DOUBLE AS f4, payment_delay::DOUBLE AS f5, last_interaction::DOUBLE AS f6,
         total_spend AS f7, commitment::DOUBLE AS f8, coalesce(tenure::DOUBLE / nullif(commitment, 0), 0) AS f9,
         usage_frequency / 30.0::DOUBLE * (30 - last_interaction) AS f10,
         CASE WHEN tenure = 0 THEN 0 ELSE total_spend / (tenure / 12.0::DOUBLE) END AS f11,
         CASE WHEN tenure = 0 THEN 0 ELSE support_calls / (tenure / 12.0::DOUBLE) END AS f12,
         (payment_delay > 15)::INTEGER::DOUBLE AS f13, (last_interaction > 15)::INTEGER::DOUBLE AS f14,
         (gender = 'Female')::INTEGER::DOUBLE AS f15, (gender = 'Male')::INTEGER::DOUBLE AS f16,
         (subscription_type = 'Basic')::INTEGER::DOUBLE AS f17, (subscription_type = 'Premium')::INTEGER::DOUBLE AS f18,
         (subscription_type = 'Standard')::INTEGER::DOUBLE AS f19, (contract_length = 'Annual')::INTEGER::DOUBLE AS f20,
         (contract_length = 'Monthly')::INTEGER::DOUBLE AS f21, (contract_length = 'Quarterly')::INTEGER::DOUBLE AS f22
  FROM (SELECT *, CASE contract_length WHEN 'Monthly' THEN 1 WHEN 'Quarterly' THEN 4 ELSE 12 END AS commitment FROM valid_customers)
),
long AS (UNPIVOT built ON COLUMNS('^f[0-9]+$') INTO NAME feature VALUE v),
widest AS (SELECT max(w) * 1e-9::DOUBLE AS extra FROM (SELECT var_pop(v) AS w FROM long WHERE train GROUP BY feature)),
moments AS (SELECT feature, churn, avg(v) AS m, var_pop(v) + (SELECT extra FROM widest) AS s FROM long WHERE train GROUP BY ALL),
odds AS (
  SELECT customerid, any_value(l.churn) AS churn,
         sum((CASE WHEN q.churn = 1 THEN 1 ELSE -1 END) * (-0.5::DOUBLE * ln(q.s) - (v - m) * (v - m) / (2 * q.s))) AS gap
  FROM long l JOIN moments q ON q.feature = l.feature WHERE NOT train GROUP BY customerid
)"""

# Seven nearest training customers by brute force over the standardised feature matrix.
_NEAREST = """
scale AS (
  SELECT feature, avg(v) AS m, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS d FROM long WHERE train GROUP BY feature),
z AS (
  SELECT customerid, churn, train, feature, CASE WHEN substr(feature, 2)::INTEGER <= 14 THEN (v - m) / d ELSE v END AS v
  FROM long JOIN scale USING (feature)),
pairs AS (
  SELECT q.customerid, any_value(q.churn) AS churn, t.customerid AS other, any_value(t.churn) AS vote, sum((q.v - t.v) * (q.v - t.v)) AS gap
  FROM z q JOIN z t ON q.feature = t.feature WHERE NOT q.train AND t.train GROUP BY q.customerid, t.customerid),
near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY customerid ORDER BY gap) <= 7)"""



def _stump(number: int) -> str:
    """CTEs of one boosted tree of two leaves: all cuts of all features, the best one, raw scores after it."""
    before = f"raw{number - 1}"
    return f"""
slopes{number} AS (SELECT customerid, train, raw, 1 / (1 + exp(-raw)) - churn AS g, (1 / (1 + exp(-raw))) * (1 - 1 / (1 + exp(-raw))) AS h FROM {before}),
whole{number} AS (SELECT sum(g) AS g, sum(h) AS h, count(*) AS n FROM slopes{number} WHERE train),
cells{number} AS (
  SELECT feature, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM long JOIN slopes{number} USING (customerid) WHERE slopes{number}.train GROUP BY feature, v),
cuts{number} AS (
  SELECT feature, (v + lead(v) OVER o) / 2 AS cut, sum(g) OVER o AS gl, sum(h) OVER o AS hl, sum(n) OVER o AS nl FROM cells{number}
  WINDOW o AS (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
best{number} AS (
  SELECT feature, cut, -0.4::DOUBLE * gl / (hl + 1.5::DOUBLE) AS low, -0.4::DOUBLE * (w.g - gl) / (w.h - hl + 1.5::DOUBLE) AS high
  FROM cuts{number}, whole{number} w WHERE cut IS NOT NULL AND nl >= 20 AND w.n - nl >= 20
  ORDER BY round(gl * gl / (hl + 1.5::DOUBLE) + (w.g - gl) * (w.g - gl) / (w.h - hl + 1.5::DOUBLE), 9) DESC, substr(feature, 2)::INTEGER, cut LIMIT 1),
raw{number} AS (
  SELECT l.customerid, l.train, any_value(l.churn) AS churn, any_value(p.raw) + any_value(CASE WHEN l.v <= b.cut THEN b.low ELSE b.high END) AS raw
  FROM long l JOIN best{number} b ON b.feature = l.feature JOIN {before} p ON p.customerid = l.customerid GROUP BY l.customerid, l.train)"""


ORACLES = {
    "train_hgb_stumps": with_views(
        CUSTOMERS, _BAYES.split("widest AS", 1)[0].rstrip().rstrip(","),
        "raw0 AS (SELECT customerid, churn, train, (SELECT ln(sum(churn)::DOUBLE / (count(*) - sum(churn))) FROM built WHERE train) AS raw FROM built)",
        _stump(1), _stump(2),
        query="SELECT customerid, churn, round(round(1 / (1 + exp(-raw)), 10), 6) AS predicted_probability FROM raw2 WHERE NOT train",
    ),
    "train_knn_score": with_views(
        CUSTOMERS, _BAYES.split("widest AS", 1)[0].rstrip().rstrip(","), _NEAREST,
        query="""
SELECT customerid, any_value(churn) AS churn, round(round(avg(vote::DOUBLE), 10), 6) AS predicted_probability
FROM near GROUP BY customerid""",
    ),
    **dict.fromkeys(
        ("train_nb_score", "train_nb_table_score"),
        with_views(
            CUSTOMERS, _BAYES,
            query="""
SELECT customerid, churn, round(round(1 / (1 + exp(-(gap + (SELECT ln(sum(churn)::DOUBLE / (count(*) - sum(churn))) FROM built WHERE train)))), 10), 6)
       AS predicted_probability FROM odds""",
        ),
    ),
    "category_numbers": """
WITH place AS (
  UNPIVOT (SELECT p_name, p_brand, p_type FROM part) ON p_name, p_brand, p_type INTO NAME column_name VALUE label
)
SELECT DISTINCT column_name AS "column", label, dense_rank() OVER (PARTITION BY column_name ORDER BY label) - 1 AS number FROM place""",
    "imputed_scaled": with_views(
        CUSTOMERS,
        """gaps AS (SELECT customerid, CASE WHEN customerid % 5 <> 0 THEN age END AS age,
       CASE WHEN customerid % 7 <> 0 THEN total_spend END AS total_spend,
       CASE WHEN customerid % 3 <> 0 THEN gender END AS gender FROM customers)""",
        """fills AS (SELECT quantile_cont(age::DOUBLE, 0.5) AS a, quantile_cont(total_spend, 0.5) AS t,
       (SELECT gender FROM gaps WHERE gender IS NOT NULL GROUP BY gender ORDER BY count(*) DESC, gender LIMIT 1) AS g FROM gaps)""",
        "filled AS (SELECT customerid, coalesce(age, a) AS age, coalesce(total_spend, t) AS total_spend, coalesce(gender, g) AS gender FROM gaps, fills)",
        query="""
SELECT customerid, round(round((age - (SELECT avg(age) FROM filled)) / (SELECT stddev_pop(age) FROM filled), 10), 6) AS age,
       round(round((total_spend - (SELECT avg(total_spend) FROM filled)) / (SELECT stddev_pop(total_spend) FROM filled), 10), 6) AS total_spend, gender
FROM filled""",
    ),
    "majority_baseline": with_views(
        CUSTOMERS,
        query="SELECT customerid, (SELECT CASE WHEN sum(churn) * 2 > count(*) THEN 1.0 ELSE 0.0 END FROM customers)::DOUBLE AS prediction FROM customers",
    ),
    "temporal_folds": with_views(
        CUSTOMERS,
        "d AS (SELECT *, dense_rank() OVER (ORDER BY reference_date) - 1 AS r FROM valid_customers)",
        "t AS (SELECT max(r) + 1 AS total, (max(r) + 1) // 4 AS size FROM d)",
        "f AS (SELECT unnest([1, 2, 3])::INTEGER AS fold)",
        query="""
SELECT fold, CASE WHEN r < total - (4 - fold) * size THEN 'train' ELSE 'validation' END AS role,
       count(*) AS rows, min(reference_date) AS first_time, max(reference_date) AS last_time
FROM d, t, f WHERE r < total - (3 - fold) * size GROUP BY ALL""",
    ),
    "batch_score_rule": with_views(
        CUSTOMERS,
        query=f"""
SELECT customerid, {_RULE}::DOUBLE AS predicted_probability, {_RULE} AS predicted_class, 0.5::DOUBLE AS threshold, 3 AS model_version
FROM valid_customers""",
    ),
    "sample_run_file": with_views(
        CUSTOMERS,
        query=f"""
SELECT customerid, {_RULE}::DOUBLE AS predicted_probability, {_RULE} AS predicted_class, 3 AS model_version, '0012' AS run_id
FROM valid_customers ORDER BY md5('7|' || customerid), customerid LIMIT 200""",
    ),
    "mean_probability": with_views(
        CUSTOMERS,
        query=f"SELECT count(*) AS rows, round(round(avg({_RULE}::DOUBLE), 10), 6) AS mean_probability FROM valid_customers",
    ),
    "sample_scoring": with_views(
        CUSTOMERS,
        query=f"""
SELECT customerid, {_RULE}::DOUBLE AS predicted_probability FROM customers ORDER BY md5('7|' || customerid), customerid LIMIT 200""",
    ),
}
