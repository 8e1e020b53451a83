"""Contract checks, quarantine and engineered features."""

import pytest
from pyspark.sql import functions as F

from cohorta.contracts import CHURN, ColumnRule, UseCase, get_use_case, register_use_case
from cohorta.functions.features import ENGINEERED, engineer
from cohorta.functions.scalars import normalize_names
from cohorta.operators.validation import (
    ContractError,
    quarantine,
    select_features,
    validate,
    violations,
)

FEATURE_SCHEMA = (
    "tenure double, contract_length string, usage_frequency double, last_interaction double, "
    "total_spend double, support_calls double, payment_delay double"
)
FEATURE_ROWS = [
    (0.0, "Monthly", 10.0, 5.0, 0.0, 10.0, 25.0),
    (12.0, "Quarterly", 20.0, 15.0, 400.0, 6.0, 10.0),
    (24.0, "Annual", 30.0, 20.0, 1000.0, 1.0, 0.0),
    (60.0, "Monthly", None, 10.0, None, 2.0, None),
    (None, None, 5.0, None, 750.0, None, 30.0),
]


@pytest.fixture()
def built(spark):
    return engineer(spark.createDataFrame(FEATURE_ROWS, FEATURE_SCHEMA)).collect()


def column(rows, name, count=3):
    return [row[name] for row in rows[:count]]


def test_feature_values(built):
    assert column(built, "contract_commitment") == [1, 4, 12]
    assert column(built, "tenure_rel2_commitment")[1:] == [3, 2]
    assert column(built, "engagement")[1:] == [10, 10]
    assert column(built, "avg_spend_per_year") == [0, 400, 500]
    assert column(built, "avg_s_calls_per_year") == [0, 6, 0.5]
    assert column(built, "late_payer") == [1, 0, 0]
    assert column(built, "inactive_customer") == [0, 0, 1]


def test_features_are_never_missing(built):
    for row in built:
        for name in ENGINEERED:
            assert row[name] is not None and abs(row[name]) < float("inf")


def test_feature_builder_needs_its_columns(spark):
    frame = spark.createDataFrame(FEATURE_ROWS, FEATURE_SCHEMA).drop("tenure")
    with pytest.raises(ValueError, match="tenure"):
        engineer(frame)


def test_names_out():
    assert CHURN.names_out(["a"]) == ["a", *ENGINEERED]


def test_validate_types_and_drops_undeclared_columns(customers):
    text = customers.select(*[F.col(c).cast("string").alias(c) for c in customers.columns])
    checked = validate(text.withColumn("note", F.lit("x")), CHURN)
    assert "note" not in checked.columns
    assert dict(checked.dtypes)["age"] == "bigint" and dict(checked.dtypes)["total_spend"] == "double"
    assert checked.count() == 12


@pytest.mark.parametrize(
    ("name", "value", "rule"),
    [
        ("age", "age", "wrong_type"),
        ("churn", 2, "not_allowed"),
        ("total_spend", -100, "out_of_range"),
        ("age", 10, "out_of_range"),
        ("age", 116, "out_of_range"),
        ("gender", "Other", "not_allowed"),
        ("tenure", None, "missing_value"),
    ],
)
def test_broken_values_are_named(customers, name, value, rule):
    broken = customers.withColumn(name, F.when(F.col("customerid") == 1003, F.lit(None if value is None else str(value))).otherwise(F.col(name).cast("string")))
    with pytest.raises(ContractError) as caught:
        validate(broken, CHURN)
    assert caught.value.failures == {(name, rule): 1}


def test_missing_required_column(customers):
    with pytest.raises(ContractError, match="age"):
        validate(customers.drop("age"), CHURN)


def test_optional_columns_may_be_absent(customers):
    assert validate(customers.drop("customerid", "churn"), CHURN).count() == 12


def test_violations_and_quarantine_agree(customers):
    broken = customers.withColumns(
        {
            "age": F.when(F.col("customerid") < 1004, F.lit(5)).otherwise(F.col("age")),
            "gender": F.when(F.col("customerid") == 1002, F.lit("?")).otherwise(F.col("gender")),
        }
    )
    found = {(r[0], r[1]): r[2] for r in violations(broken, CHURN).where("failed_rows > 0").collect()}
    assert found == {("age", "out_of_range"): 3, ("gender", "not_allowed"): 1}
    valid, invalid = quarantine(broken, CHURN)
    assert valid.count() == 9
    assert {r["customerid"]: sorted(r["reasons"]) for r in invalid.collect()} == {
        1001: ["age:out_of_range"],
        1002: ["age:out_of_range", "gender:not_allowed"],
        1003: ["age:out_of_range"],
    }


def test_feature_selection_keeps_declared_order(customers):
    assert select_features(customers, CHURN.feature_columns).columns == list(CHURN.feature_columns)
    with pytest.raises(ValueError, match="gender"):
        select_features(customers.drop("gender"), CHURN.feature_columns)


def test_names_are_normalised_and_must_stay_distinct(spark):
    frame = spark.createDataFrame([(1, 2)], [" Total Spend ", "Age"])
    assert normalize_names(frame).columns == ["total_spend", "age"]
    with pytest.raises(ValueError, match="age"):
        normalize_names(spark.createDataFrame([(1, 2)], ["age", " AGE"]))


def test_use_case_rules_and_registry():
    with pytest.raises(ValueError):
        UseCase("x", "y", "t", ("y",), ())
    with pytest.raises(ValueError):
        UseCase("", "y", "t", ("a",), ())
    with pytest.raises(ValueError, match="churn"):
        get_use_case("unknown")
    second = register_use_case(UseCase("second", "label", "event_date", ("amount",), (ColumnRule("amount", "double"),)))
    assert get_use_case("second") is second


def test_validation_is_one_aggregate(customers):
    plan = violations(customers, CHURN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_not_a_number_is_a_missing_value(spark):
    case = UseCase("nan", "y", "t", ("v",), (ColumnRule("v", "double", low=0),))
    rows = spark.createDataFrame([(1.5,), (float("nan"),), (-2.0,), (None,)], "v double")
    assert {r["rule"]: r["failed_rows"] for r in violations(rows, case).collect()} == {
        "missing_value": 2, "wrong_type": 0, "out_of_range": 1,
    }
    text = spark.createDataFrame([("1.5",), ("NaN",), ("x",), (None,)], "v string")
    assert {r["rule"]: r["failed_rows"] for r in violations(text, case).collect()} == {
        "missing_value": 2, "wrong_type": 1, "out_of_range": 0,
    }
