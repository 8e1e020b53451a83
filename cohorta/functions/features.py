"""Engineered features of the churn contract: one stateless projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.functions.scalars import ratio, require_columns

# Months bound by each contract length, and the two day limits.
COMMITMENT_MONTHS = {"Monthly": 1, "Quarterly": 4, "Biannual": 6, "Annual": 12}
LATE_AFTER_DAYS = 15
INACTIVE_AFTER_DAYS = 15
DAYS_PER_MONTH = 30
MONTHS_PER_YEAR = 12

ENGINEERED = (
    "contract_commitment",
    "tenure_rel2_commitment",
    "engagement",
    "avg_spend_per_year",
    "avg_s_calls_per_year",
    "late_payer",
    "inactive_customer",
)

NEEDED = (
    "tenure",
    "contract_length",
    "usage_frequency",
    "last_interaction",
    "total_spend",
    "support_calls",
    "payment_delay",
)


def commitment() -> Column:
    months = F.lit(0)
    for length, count in COMMITMENT_MONTHS.items():
        months = F.when(F.col("contract_length") == length, count).otherwise(months)
    return months


def _zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _per_year(column: str) -> Column:
    years = F.col("tenure").cast("double") / MONTHS_PER_YEAR
    return _zero_if_null(ratio(F.col(column), years))


def _over(column: str, limit: int) -> Column:
    return F.coalesce(F.col(column) > limit, F.lit(False)).cast("int")


def engineer(df: DataFrame) -> DataFrame:
    """Append the seven engineered columns."""
    require_columns(df, NEEDED, "feature builder")
    active_days = DAYS_PER_MONTH - F.col("last_interaction")
    usage_per_day = F.col("usage_frequency").cast("double") / DAYS_PER_MONTH
    return df.withColumns(
        {
            "contract_commitment": commitment(),
            "tenure_rel2_commitment": _zero_if_null(ratio(F.col("tenure"), commitment())),
            "engagement": _zero_if_null(usage_per_day * active_days),
            "avg_spend_per_year": _per_year("total_spend"),
            "avg_s_calls_per_year": _per_year("support_calls"),
            "late_payer": _over("payment_delay", LATE_AFTER_DAYS),
            "inactive_customer": _over("last_interaction", INACTIVE_AFTER_DAYS),
        }
    )


def rule_classifier() -> Column:
    """Baseline classifier made of plain limits; 0 or 1."""
    # Limits of the rule benchmark.
    hit = (
        (F.col("age") > 50)
        | (F.col("support_calls") >= 6)
        | (F.col("payment_delay") > 20)
        | (F.col("total_spend") <= 500)
        | (F.col("contract_length") == "Monthly")
    )
    return F.coalesce(hit, F.lit(False)).cast("int")
