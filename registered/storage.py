"""Readers, writers and run tables, exercised on data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.operators import metrics as M
from cohorta.operators import promotion as R
from cohorta.plans import views as V
from cohorta.plans.ingest import ingest_events, ingest_runs, malformed_folder, with_reference_dates
from cohorta.plans.replay import ingest_log, read_ingested, read_malformed
from cohorta.session import new_workspace
from cohorta.sources import delimited, events, monthly, splits
from cohorta.sources.registry import ModelRegistry
from registered.derived import API, CUSTOMERS, SCORED, with_views
from registered.metrics import BINS, THRESHOLD, P, Y, rounded

TIME = "reference_date"
START, SPLIT, END = "2000-01-01", "2001-01-01", "2001-06-30"


def _dataset(spark, sf_dir):
    """The valid customers as a monthly dataset in a fresh folder."""
    path = new_workspace(spark, "monthly")
    monthly.write_monthly(V.valid_customers(spark, sf_dir), path, TIME)
    return path


def monthly_write_read(spark, sf_dir):
    path = _dataset(spark, sf_dir)
    rows = monthly.read_monthly(spark, path, TIME, "2000-03-01", "2001-02-28")
    return rows.select("customerid", TIME, "year", "month")


def monthly_overwrite(spark, sf_dir):
    """Rows per month after the months of 2001 were replaced by fewer rows."""
    path = _dataset(spark, sf_dir)
    fewer = V.valid_customers(spark, sf_dir).where(
        (F.col(TIME) >= F.lit("2001-01-01").cast("timestamp_ntz")) & (F.col("gender") == "Male")
    )
    monthly.write_monthly(fewer, path, TIME, overwrite_partitions=True)
    whole = monthly.read_monthly(spark, path, TIME)
    return whole.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


def month_keys(spark, sf_dir):
    """Months of a dataset that a range touches."""
    path = _dataset(spark, sf_dir)
    kept = spark.read.parquet(path).where(monthly.month_predicate("1999-12-15", "2000-06-01"))
    return kept.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


def oot_split(spark, sf_dir):
    path, target = _dataset(spark, sf_dir), new_workspace(spark, "splits")
    splits.create_split(spark, path, TIME, START, SPLIT, END, target, "oot")
    train, test = splits.read_split(spark, target, "oot", CHURN)
    return (
        train.withColumn("split", F.lit("train"))
        .unionByName(test.withColumn("split", F.lit("test")))
        .select("split", "customerid", TIME, "churn")
    )


def split_metadata(spark, sf_dir):
    path = _dataset(spark, sf_dir)
    rows = monthly.read_monthly(spark, path, TIME, START, END)
    return splits.split_metadata(splits.with_split(rows, TIME, SPLIT), TIME)


def split_record(spark, sf_dir):
    """The record beside a written split, read again."""
    path, target = _dataset(spark, sf_dir), new_workspace(spark, "splits")
    splits.create_split(spark, path, TIME, START, SPLIT, END, target, "oot")
    found = splits.read_split_metadata(spark, target, "oot")
    return spark.createDataFrame([tuple(found.values())], list(found))


def raw_csv_round_trip(spark, sf_dir):
    """Customers written as CSV with untidy headers, some rows empty but for the key, read back."""
    path = new_workspace(spark, "raw")
    rows = V.customers(spark, sf_dir).select(
        F.col("customerid").alias("CustomerID"),
        *[
            F.when(F.col("customerid") % 10 != 0, F.col(c)).alias(header)
            for c, header in (
                ("age", " Age "),
                ("total_spend", "Total Spend"),
                ("contract_length", "Contract Length"),
                ("gender", "Extra Value"),
            )
        ],
    )
    delimited.write_csv(rows, path)
    return delimited.read_raw_csv(
        spark, path, "customerid", ["extra value"], CHURN.rules
    )


def run_files(spark, sf_dir):
    """Two numbered result files side by side, told apart by their number."""
    path = new_workspace(spark, "runs")
    scored = V.customers(spark, sf_dir).select("customerid", "churn")
    for number, part in ((1, 0), (42, 1)):
        folder = f"{path}/{number:04d}_sample_predictions.csv"
        delimited.write_csv(scored.where(F.col("customerid") % 2 == part), folder)
    whole = delimited.read_run_files(spark, path)
    return whole.select(
        F.col("customerid").cast("bigint").alias("customerid"),
        F.col("churn").cast("bigint").alias("churn"),
        "run_id",
    )


def _log(spark, sf_dir, kind):
    path = new_workspace(spark, "log")
    rows = V.api_events(spark, sf_dir).where(F.col("event") == kind)
    if kind == events.PREDICTION:
        records = events.prediction_records(rows, V.REQUESTS)
    else:
        records = events.error_records(
            rows.withColumns({"error_type": F.lit("ValueError"), "error_message": F.col("request_id")}),
            V.REQUESTS,
        )
    events.write_events(records, path)
    return path


def ingested_runs(spark, sf_dir):
    """Numbered files of valid customers brought into a monthly dataset, twice."""
    path, dataset = new_workspace(spark, "runs"), new_workspace(spark, "ingested")
    rows = V.valid_customers(spark, sf_dir)
    for number, part in ((3, 0), (7, 1)):
        delimited.write_csv(rows.where(F.col("customerid") % 2 == part), f"{path}/{number:04d}_sample_predictions.csv")
    for _ in range(2):
        ingest_runs(spark, path, dataset, CHURN)
    found = monthly.read_monthly(spark, dataset, TIME)
    return found.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"), F.sum("age").alias("ages"))


def flatten_event_features(spark, sf_dir):
    """Prediction events written as JSON lines and read back flat."""
    log = _log(spark, sf_dir, events.PREDICTION)
    return events.load_events(spark, log, events.PREDICTION, V.REQUESTS).select(
        "request_id", TIME, "latency_ms", "model_version", "predicted_class", "amount", "k", "channel"
    )


def error_event_log(spark, sf_dir):
    log = _log(spark, sf_dir, events.PREDICTION_ERROR)
    return events.load_events(spark, log, events.PREDICTION_ERROR, V.REQUESTS).select(
        "request_id", TIME, "latency_ms", "error_type", "error_message", "k"
    )


def ingested_events(spark, sf_dir):
    """Event log ingested twice into a monthly dataset: the month is replaced, not doubled."""
    log, dataset = _log(spark, sf_dir, events.PREDICTION), new_workspace(spark, "ingested")
    for _ in range(2):
        ingest_events(spark, log, dataset, V.REQUESTS)
    rows = monthly.read_monthly(spark, dataset, TIME)
    return rows.groupBy("year", "month", "model_version").agg(F.count(F.lit(1)).alias("rows"))


def ingested_sides(spark, sf_dir):
    """Event log with cut-off lines and unreadable times: rows on both sides of the ingestion."""
    number = F.get_json_object("value", "$.request_id").cast("bigint")
    dated = F.regexp_replace("value", '"reference_date":"[^"]*"', '"reference_date":"yesterday"')
    line = F.when(number % 7 == 0, F.substring("value", 1, 40)).when(number % 11 == 0, dated).otherwise(F.col("value"))
    log, dataset = new_workspace(spark, "log"), new_workspace(spark, "ingested")
    spark.read.text(_log(spark, sf_dir, events.PREDICTION)).select(line.alias("value")).write.text(log)
    ingest_events(spark, log, dataset, V.REQUESTS)
    good = monthly.read_monthly(spark, dataset, TIME).select(F.lit("ingested").alias("side"))
    bad = spark.read.text(malformed_folder(dataset, log)).select(F.lit("malformed").alias("side"))
    return good.unionByName(bad).groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


def _broken_log(spark, sf_dir, path):
    """A prediction log in which every seventh line is cut off."""
    number = F.get_json_object("value", "$.request_id").cast("bigint")
    line = F.when(number % 7 == 0, F.substring("value", 1, 60)).otherwise(F.col("value"))
    spark.read.text(_log(spark, sf_dir, events.PREDICTION)).select(line.alias("value")).write.text(path)
    return path


def _sides(good, bad):
    sides = good.select(F.lit("good").alias("side")).unionByName(bad.select(F.lit("malformed").alias("side")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


def malformed_by_log(spark, sf_dir):
    """Two logs of one file name in two folders: each keeps its own malformed lines."""
    dataset, folder = new_workspace(spark, "ingested"), new_workspace(spark, "logs")
    whole = spark.read.text(_broken_log(spark, sf_dir, f"{folder}/all"))
    number = F.regexp_extract("value", '"request_id":"([0-9]+)"', 1).cast("bigint")
    found = []
    for part in (0, 1):
        log = f"{folder}/{part}/events.jsonl"
        whole.where(number % 2 == part).write.text(log)
        ingest_events(spark, log, dataset, V.REQUESTS)
        found.append(malformed_folder(dataset, log))
    first, second = (spark.read.text(path).select(F.lit(part).alias("log")) for part, path in enumerate(found))
    return first.unionByName(second).groupBy("log").agg(F.count(F.lit(1)).alias("rows"))


def replayed_logs(spark, sf_dir):
    """Two logs of one file name and the same months; one grows, and every state is ingested twice."""
    dataset, folder = new_workspace(spark, "replayed"), new_workspace(spark, "logs")
    whole = spark.read.text(_broken_log(spark, sf_dir, f"{folder}/all"))
    number = F.regexp_extract("value", '"request_id":"([0-9]+)"', 1).cast("bigint")
    logs = [f"{folder}/{part}/events.jsonl" for part in (0, 1)]
    for grown in (0, 1):
        for part, log in enumerate(logs):
            if part == 0 or grown == 0:
                later = (number % 3 == 0) == bool(grown) if part == 0 else F.lit(True)
                whole.where((number % 2 == part) & later).write.mode("append").text(log)
            for _ in range(2):
                ingest_log(spark, log, dataset, V.REQUESTS)
    good = read_ingested(spark, dataset, V.REQUESTS).select(F.lit(-1).alias("log"), "year", "month")
    bad = read_malformed(spark, dataset, V.REQUESTS).select(
        F.when(F.col("log") == logs[0], 0).otherwise(1).alias("log"),
        *[F.lit(None).cast("int").alias(name) for name in ("year", "month")],
    )
    return good.unionByName(bad).groupBy("log", "year", "month").agg(F.count(F.lit(1)).alias("rows"))


def alias_metrics(spark, sf_dir):
    """Both model versions registered with their figures, the more accurate one promoted last."""
    scored = V.scored(spark, sf_dir)
    gap, hit = F.col(P) - F.col(Y), (F.col("predicted_class") == F.col(Y)).cast("double")
    figures = scored.groupBy("model_version").agg(F.avg(gap * gap).alias("brier"), F.avg(hit).alias("accuracy"))
    registry = ModelRegistry(spark, new_workspace(spark, "registry"))
    for row in figures.orderBy("accuracy").collect():  # one row a model version
        values = {"brier": row["brier"], "accuracy": row["accuracy"]}
        number = registry.register("returns", f"run-{row['model_version']}", "returns", 0.5, "", values)
        registry.promote("returns", number, True)
    found = R.metrics_by_alias(registry.alias_history(), registry.versions(), registry.metrics())
    return rounded(found)


def loaded_sides(spark, sf_dir):
    """A log with cut-off lines as monitoring loads it: events, and lines kept as text."""
    folder = new_workspace(spark, "loaded")
    log = _broken_log(spark, sf_dir, f"{folder}/log")
    good = events.load_events(spark, log, events.PREDICTION, V.REQUESTS, malformed_to=f"{folder}/bad")
    return _sides(good, spark.read.text(f"{folder}/bad"))


def json_csv_sides(spark, sf_dir):
    """The same log turned into CSV: rows of the CSV, and lines kept beside it."""
    folder = new_workspace(spark, "csv")
    log = _broken_log(spark, sf_dir, f"{folder}/log")
    events.json_to_csv(spark, log, f"{folder}/rows", V.REQUESTS)
    return _sides(spark.read.csv(f"{folder}/rows", header=True), spark.read.text(f"{folder}/rows-malformed"))


def reference_dates(spark, sf_dir):
    """Customers spread evenly over the months of a year."""
    rows = V.customers(spark, sf_dir).select("customerid")
    return with_reference_dates(rows, "2025-01-01", "2025-12-01", "assigned", "customerid")


def run_metrics(spark, sf_dir):
    """Long metric table of eight models over the scored line items."""
    rows = V.scored(spark, sf_dir).withColumn(
        "run_id", F.concat(F.lit("run-"), (F.col("l_suppkey") % 8).cast("string"))
    )
    wide = M.evaluation_row(rows, Y, P, THRESHOLD, BINS, ["run_id"])
    names = list(R.DEFAULT_WEIGHTS)
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return wide.select("run_id", F.inline(pairs))


def weighted_scores(spark, sf_dir):
    return rounded(R.weighted_scores(run_metrics(spark, sf_dir)))


def _pairs(metrics):
    runs = metrics.select("run_id").distinct()
    return runs.withColumn(
        "champion_run_id", F.when(F.col("run_id") != "run-0", F.lit("run-0"))
    )


def promotion_decisions(spark, sf_dir):
    metrics = run_metrics(spark, sf_dir)
    decided = R.promotion_decisions(_pairs(metrics), R.weighted_scores(metrics), 0.0001)
    return rounded(decided)


def _versions(spark, sf_dir):
    """Suppliers as registered versions of one model per nation."""
    return V.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("model-"), (F.col("s_suppkey") % 5).cast("string")).alias("model_name"),
        F.col("s_suppkey").cast("int").alias("model_version"),
        F.concat(F.lit("run-"), F.col("s_suppkey").cast("string")).alias("run_id"),
        F.when(F.col("s_suppkey") % 5 == 4, "returns").otherwise("churn").alias("use_case"),
        (F.col("s_suppkey") % 100 / 100.0).cast("double").alias("threshold"),
    )


def _aliases(spark, sf_dir):
    """Alias history: each version was champion once, every third a former champion."""
    history = _versions(spark, sf_dir).select(
        "model_name", "model_version", (F.col("model_version") * 37 % 1009).cast("bigint").alias("assigned_at")
    )
    alias = F.when(F.col("model_version") % 3 == 0, R.FORMER_CHAMPION).otherwise(R.CHAMPION)
    return history.withColumn("alias", alias)


def current_aliases(spark, sf_dir):
    return R.current_aliases(_aliases(spark, sf_dir))


def next_versions(spark, sf_dir):
    return R.next_versions(_versions(spark, sf_dir))


def resolve_model(spark, sf_dir):
    """One request per registered version: by alias, by number, by both, or for a wrong number."""
    versions = _versions(spark, sf_dir)
    kind = F.col("model_version") % 4
    requests = versions.select(
        "model_name",
        F.lit("churn").alias("use_case"),
        F.when(kind.isin(0, 2), R.CHAMPION).alias("alias"),
        F.when(kind.isin(1, 2), F.col("model_version"))
        .when(kind == 3, -F.col("model_version"))
        .alias("model_version"),
    )
    return R.resolve_models(requests, versions, _aliases(spark, sf_dir))


QUERIES = {
    "monthly_write_read": monthly_write_read,
    "monthly_overwrite": monthly_overwrite,
    "month_keys": month_keys,
    "oot_split": oot_split,
    "split_metadata": split_metadata,
    "raw_csv_round_trip": raw_csv_round_trip,
    "split_record": split_record,
    "run_files": run_files,
    "ingested_runs": ingested_runs,
    "flatten_event_features": flatten_event_features,
    "error_event_log": error_event_log,
    "ingested_events": ingested_events,
    "ingested_sides": ingested_sides,
    "malformed_by_log": malformed_by_log,
    "replayed_logs": replayed_logs,
    "alias_metrics": alias_metrics,
    "loaded_sides": loaded_sides,
    "json_csv_sides": json_csv_sides,
    "reference_dates": reference_dates,
    "weighted_scores": weighted_scores,
    "promotion_decisions": promotion_decisions,
    "current_aliases": current_aliases,
    "next_versions": next_versions,
    "resolve_model": resolve_model,
}

_SCORES = """
m AS (SELECT 'run-' || (l_suppkey % 8) AS run_id, returned AS y, predicted_probability AS p FROM scored),
ranks AS (
  SELECT run_id, y, p, rank() OVER (PARTITION BY run_id ORDER BY p)
         + (count(*) OVER (PARTITION BY run_id, p) - 1) / 2.0::DOUBLE AS r FROM m),
cells AS (SELECT run_id, p, sum(y)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM m GROUP BY ALL),
cuts AS (SELECT a.run_id, a.p, any_value(a.pos) AS pos, sum(b.pos) AS tp, sum(b.n) AS hits
         FROM cells a JOIN cells b ON a.run_id = b.run_id AND b.p >= a.p GROUP BY ALL),
parts AS (
  SELECT run_id, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y)::DOUBLE * (count(*) - sum(y))) AS roc_auc,
         2 * count(*) FILTER (p >= 0.5 AND y = 1) / (count(*) FILTER (p >= 0.5) + sum(y))::DOUBLE AS f1,
         avg((p - y) * (p - y)) AS brier FROM ranks GROUP BY ALL),
ap AS (SELECT run_id, sum(pos * tp / hits) / sum(pos) AS pr_auc FROM cuts GROUP BY ALL),
ece AS (
  SELECT run_id, sum(abs(mp - my) * n) / sum(n) AS ece FROM (
    SELECT run_id, greatest(ceil(p * 10), 1) AS b, avg(p) AS mp, avg(y::DOUBLE) AS my, count(*) AS n FROM m GROUP BY ALL)
  GROUP BY ALL),
scores AS (
  SELECT run_id, 0 AS missing, 0 AS invalid, (roc_auc + pr_auc + f1 + (1 - brier) + (1 - ece)) / 5 AS score
  FROM parts JOIN ap USING (run_id) JOIN ece USING (run_id))"""

_VERSIONS = """
versions AS (
  SELECT 'model-' || (s_suppkey % 5) AS model_name, s_suppkey::INTEGER AS model_version, 'run-' || s_suppkey AS run_id,
         CASE WHEN s_suppkey % 5 = 4 THEN 'returns' ELSE 'churn' END AS use_case, s_suppkey % 100 / 100.0::DOUBLE AS threshold
  FROM supplier),
history AS (
  SELECT model_name, model_version, model_version * 37 % 1009 AS assigned_at,
         CASE WHEN model_version % 3 = 0 THEN 'former_champion' ELSE 'champion' END AS alias FROM versions),
latest AS (
  SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY model_name, alias ORDER BY assigned_at DESC) = 1)"""


def _r(expression: str, name: str) -> str:
    return f"round(round({expression}, 10), 6) AS {name}"


_RANGE = f"reference_date >= TIMESTAMP '{START}' AND reference_date < TIMESTAMP '2001-07-01'"
_SIDE = f"reference_date < TIMESTAMP '{SPLIT}'"

ORACLES = {
    "monthly_write_read": with_views(
        CUSTOMERS,
        query="""
SELECT customerid, reference_date, year(reference_date)::INTEGER AS year, month(reference_date)::INTEGER AS month
FROM valid_customers WHERE reference_date BETWEEN TIMESTAMP '2000-03-01' AND TIMESTAMP '2001-02-28 23:59:59'""",
    ),
    "monthly_overwrite": with_views(
        CUSTOMERS,
        query="""
SELECT year, month, rows FROM (
SELECT year(reference_date)::INTEGER AS year, month(reference_date)::INTEGER AS month,
       CASE WHEN count(*) FILTER (gender = 'Male' AND reference_date >= TIMESTAMP '2001-01-01') > 0
            THEN count(*) FILTER (gender = 'Male') ELSE count(*) END AS rows
FROM valid_customers GROUP BY ALL)""",
    ),
    "month_keys": with_views(
        CUSTOMERS,
        query="""
SELECT year(reference_date)::INTEGER AS year, month(reference_date)::INTEGER AS month, count(*) AS rows
FROM valid_customers WHERE strftime(reference_date, '%Y-%m') BETWEEN '1999-12' AND '2000-06' GROUP BY ALL""",
    ),
    "oot_split": with_views(
        CUSTOMERS,
        query=f"SELECT CASE WHEN {_SIDE} THEN 'train' ELSE 'test' END AS split, customerid, reference_date, churn FROM valid_customers WHERE {_RANGE}",
    ),
    "split_metadata": with_views(
        CUSTOMERS,
        query=f"""
SELECT count(*) FILTER ({_SIDE}) AS train_rows, min(reference_date) FILTER ({_SIDE}) AS train_start,
       max(reference_date) FILTER ({_SIDE}) AS train_end, count(*) FILTER (NOT {_SIDE}) AS test_rows,
       min(reference_date) FILTER (NOT {_SIDE}) AS test_start, max(reference_date) FILTER (NOT {_SIDE}) AS test_end
FROM valid_customers WHERE {_RANGE}""",
    ),
    "raw_csv_round_trip": with_views(
        CUSTOMERS,
        query="SELECT customerid, age, total_spend, contract_length FROM customers WHERE customerid % 10 <> 0",
    ),
    "split_record": with_views(
        CUSTOMERS,
        query=f"""
, side AS (SELECT {_SIDE} AS train, reference_date AS t FROM valid_customers WHERE {_RANGE}),
found AS (
  SELECT train, count(*)::VARCHAR AS n, strftime(min(t), '%Y-%m-%dT%H:%M:%S') AS low, strftime(max(t), '%Y-%m-%dT%H:%M:%S') AS high
  FROM side GROUP BY train
)
SELECT a.n AS train_rows, a.low AS train_start, a.high AS train_end, b.n AS test_rows, b.low AS test_start, b.high AS test_end
FROM found a, found b WHERE a.train AND NOT b.train""",
    ),
    "ingested_runs": with_views(
        CUSTOMERS,
        query="""
SELECT year(reference_date)::INTEGER AS year, month(reference_date)::INTEGER AS month, count(*) AS rows, sum(age)::BIGINT AS ages
FROM valid_customers GROUP BY ALL""",
    ),
    "run_files": with_views(
        CUSTOMERS,
        query="SELECT customerid, churn, CASE WHEN customerid % 2 = 0 THEN '0001' ELSE '0042' END AS run_id FROM customers",
    ),
    "flatten_event_features": with_views(
        API,
        query="""
SELECT request_id, reference_date, latency_ms, model_version, predicted_class, amount, k, channel
FROM api_events WHERE event = 'prediction'""",
    ),
    "error_event_log": with_views(
        API,
        query="""
SELECT request_id, reference_date, latency_ms, 'ValueError' AS error_type, request_id AS error_message, k::VARCHAR AS k
FROM api_events WHERE event = 'prediction_error'""",
    ),
    "ingested_events": with_views(
        API,
        query="""
SELECT year(reference_date)::INTEGER AS year, month(reference_date)::INTEGER AS month, model_version, count(*) AS rows
FROM api_events WHERE event = 'prediction' GROUP BY ALL""",
    ),
    "ingested_sides": with_views(
        API,
        query="""
SELECT CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'malformed' ELSE 'ingested' END AS side, count(*) AS rows
FROM api_events WHERE event = 'prediction' GROUP BY ALL""",
    ),
    "malformed_by_log": with_views(
        API,
        query="SELECT (event_id % 2)::INTEGER AS log, count(*) AS rows FROM api_events WHERE event = 'prediction' AND event_id % 7 = 0 GROUP BY ALL",
    ),
    "alias_metrics": with_views(
        SCORED,
        query="""
, figures AS (
  SELECT model_version, avg((predicted_probability - returned) * (predicted_probability - returned)) AS brier,
         avg((predicted_class = returned)::INTEGER) AS accuracy
  FROM scored GROUP BY model_version
),
placed AS (SELECT *, row_number() OVER (ORDER BY accuracy DESC) AS place FROM figures),
long AS (
  SELECT place, 'brier' AS metric, brier AS value FROM placed UNION ALL SELECT place, 'accuracy', accuracy FROM placed
)
SELECT 'returns' AS model_name, CASE place WHEN 1 THEN 'champion' ELSE 'former_champion' END AS alias, metric,
       round(round(value, 10), 6) AS value
FROM long""",
    ),
    "replayed_logs": with_views(
        API,
        query="""
SELECT CASE WHEN event_id % 7 <> 0 THEN -1 ELSE event_id % 2 END::INTEGER AS log,
       CASE WHEN event_id % 7 <> 0 THEN year(reference_date) END::INTEGER AS year,
       CASE WHEN event_id % 7 <> 0 THEN month(reference_date) END::INTEGER AS month, count(*) AS rows
FROM api_events WHERE event = 'prediction' GROUP BY ALL""",
    ),
    **dict.fromkeys(
        ("loaded_sides", "json_csv_sides"),
        with_views(
            API,
            query="""
SELECT CASE WHEN event_id % 7 = 0 THEN 'malformed' ELSE 'good' END AS side, count(*) AS rows
FROM api_events WHERE event = 'prediction' GROUP BY ALL""",
        ),
    ),
    "reference_dates": with_views(
        CUSTOMERS,
        """o AS (SELECT customerid, row_number() OVER (ORDER BY md5('42|' || customerid), customerid) - 1 AS pos,
       count(*) OVER () AS n FROM customers)""",
        query="""
SELECT customerid, TIMESTAMP '2025-01-01' + to_months(CAST(CASE WHEN pos < (n % 12) * (n // 12 + 1) THEN pos // (n // 12 + 1)
       ELSE n % 12 + (pos - (n % 12) * (n // 12 + 1)) // (n // 12) END AS INTEGER)) AS assigned FROM o""",
    ),
    "weighted_scores": with_views(
        SCORED, _SCORES, query=f"SELECT run_id, missing, invalid, {_r('score', 'score')} FROM scores"
    ),
    "promotion_decisions": with_views(
        SCORED, _SCORES,
        query=f"""
SELECT run_id, champion_run_id, {_r('candidate_score', 'candidate_score')}, {_r('champion_score', 'champion_score')},
       0.0001::DOUBLE AS min_delta, {_r('candidate_score - champion_score', 'score_delta')},
       champion_run_id IS NULL OR candidate_score - champion_score > 0.0001 AS promote,
       CASE WHEN champion_run_id IS NULL THEN 'no champion existed'
            WHEN candidate_score - champion_score > 0.0001 THEN 'improvement above the required delta'
            ELSE 'no improvement above the required delta' END AS reason
FROM (SELECT run_id, score AS candidate_score, CASE WHEN run_id <> 'run-0' THEN 'run-0' END AS champion_run_id,
             CASE WHEN run_id <> 'run-0' THEN (SELECT score FROM scores WHERE run_id = 'run-0') END AS champion_score
      FROM scores)""",
    ),
    "current_aliases": with_views(
        _VERSIONS, query="SELECT model_name, alias, model_version, assigned_at::BIGINT AS assigned_at FROM latest"
    ),
    "next_versions": with_views(
        _VERSIONS, query="SELECT model_name, max(model_version) + 1 AS next_version FROM versions GROUP BY ALL"
    ),
    "resolve_model": with_views(
        _VERSIONS,
        """asked AS (
  SELECT v.model_name, CASE WHEN v.model_version % 4 IN (0, 2) THEN 'champion' END AS alias,
         CASE WHEN v.model_version % 4 IN (1, 2) THEN v.model_version WHEN v.model_version % 4 = 3 THEN -v.model_version END AS requested_version,
         l.model_version AS champion
  FROM versions v LEFT JOIN latest l ON l.model_name = v.model_name AND l.alias = 'champion'),
answered AS (
  SELECT a.*, v.model_version, v.run_id, v.threshold,
         CASE WHEN alias IS NOT NULL AND requested_version IS NOT NULL THEN 'ambiguous selector'
              WHEN v.run_id IS NULL THEN 'not found' WHEN v.use_case <> 'churn' THEN 'other use case' END AS problem
  FROM asked a LEFT JOIN versions v ON v.model_name = a.model_name AND v.model_version = coalesce(requested_version, champion))""",
        query="""
SELECT model_name, 'churn' AS use_case, alias, requested_version,
       CASE WHEN problem IS NULL THEN model_version END AS model_version, CASE WHEN problem IS NULL THEN run_id END AS run_id,
       CASE WHEN problem IS NULL THEN threshold END AS threshold, problem
FROM answered""",
    ),
}
