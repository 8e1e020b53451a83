"""Domain tables derived from the star-schema test tables by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import ColumnRule, UseCase, register_use_case

SPLIT_DATE = "1999-01-01"
API_SPLIT_DATE = "2024-01-16"

RETURNS = register_use_case(
    UseCase(
        name="returns",
        target_column="returned",
        time_column="reference_date",
        feature_columns=("quantity", "discount", "extended_price", "line_status"),
        rules=(
            ColumnRule("quantity", "double", low=0),
            ColumnRule("discount", "double", low=0, high=1),
            ColumnRule("extended_price", "double", low=0),
            ColumnRule("line_status", "string", allowed=("F", "O")),
            ColumnRule("returned", "int", required=False, allowed=(0, 1)),
            ColumnRule("reference_date", "timestamp_ntz", required=False),
        ),
    )
)

REQUESTS = register_use_case(
    UseCase(
        name="requests",
        target_column="converted",
        time_column="reference_date",
        feature_columns=("amount", "k", "channel"),
        rules=(
            ColumnRule("amount", "double", low=0),
            ColumnRule("k", "bigint", low=0, high=100),
            ColumnRule("channel", "string", allowed=("0", "1", "2", "3")),
            ColumnRule("converted", "int", required=False, allowed=(0, 1)),
            ColumnRule("reference_date", "timestamp_ntz", required=False),
        ),
    )
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored predictions with many tied scores."""
    y = (F.col("l_returnflag") == "R").cast("int")
    mix = F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31
    points = (mix % 700) + 300 * y
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_suppkey",
            y.alias("returned"),
            (points.cast("double") / 1000).alias("predicted_probability"),
            (points >= 500).cast("int").alias("predicted_class"),
            (1 + F.col("l_linenumber") % 2).cast("int").alias("model_version"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("reference_date"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            F.col("l_extendedprice").alias("extended_price"),
            F.col("l_linestatus").alias("line_status"),
        )
    )


def scored_cohorts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(labelled reference, analysis whose open lines have no label yet)."""
    rows = scored(spark, sf_dir).drop("l_suppkey")
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    label = F.when(F.col("line_status") != "O", F.col("returned"))
    return (
        rows.where(F.col("reference_date") < cut),
        rows.where(F.col("reference_date") >= cut).withColumn("returned", label),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the shape of the churn contract; one contract length breaks it."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("o_totalprice").alias("spent"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    key = F.col("c_custkey")
    calls, delay = key % 11, key % 31
    at_risk = (calls >= 6) | (delay > 20)
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey")
        .join(per_customer, "c_custkey", "left")
        .select(
            key.alias("customerid"),
            (18 + key % 98).alias("age"),
            (key % 60).alias("tenure"),
            F.coalesce("orders", F.lit(0)).alias("usage_frequency"),
            calls.alias("support_calls"),
            delay.alias("payment_delay"),
            (key % 30).alias("last_interaction"),
            F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("total_spend"),
            F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.element_at(F.array(*map(F.lit, ("Basic", "Standard", "Premium"))), (key % 3 + 1).cast("int")).alias("subscription_type"),
            F.element_at(F.array(*map(F.lit, ("Monthly", "Quarterly", "Annual", "Weekly"))), (key % 4 + 1).cast("int")).alias("contract_length"),
            (at_risk != (key % 17 == 0)).cast("bigint").alias("churn"),
            F.date_trunc("month", F.col("last_order")).cast("timestamp_ntz").alias("reference_date"),
        )
    )


def valid_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).where(
        (F.col("contract_length") != "Weekly") & F.col("reference_date").isNotNull()
    )


def api_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events as service events: errors and scored predictions."""
    key, user = F.col("event_id"), F.col("user_id")
    points = (key * 7919 + user * 31) % 1000
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.when(failed, "prediction_error").otherwise("prediction").alias("event"),
        key.cast("string").alias("request_id"),
        F.col("ts").cast("timestamp_ntz").alias("reference_date"),
        F.col("value").alias("latency_ms"),
        F.lit("requests-model").alias("model_name"),
        (1 + user % 2).cast("int").alias("model_version"),
        F.when(~failed, points.cast("double") / 1000).alias("predicted_probability"),
        F.when(~failed, (points >= 500).cast("int")).alias("predicted_class"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (user % 4).cast("string").alias("channel"),
        F.when(~failed, ((points + key % 500) >= 700).cast("int")).alias("converted"),
    )


def api_cohorts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(labelled reference days, unlabelled analysis days, failed requests of those days)."""
    events = api_events(spark, sf_dir)
    early = F.col("reference_date") < F.lit(API_SPLIT_DATE).cast("timestamp_ntz")
    success, failed = F.col("event") == "prediction", F.col("event") == "prediction_error"
    return (
        events.where(early & success),
        events.where(~early & success).drop("converted"),
        events.where(~early & failed).drop(
            "predicted_probability", "predicted_class", "converted"
        ),
    )
