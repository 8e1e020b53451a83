import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohorta.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cohorta-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="cohorta-test-")


FEATURES = {
    "age": "bigint", "tenure": "bigint", "usage_frequency": "bigint", "support_calls": "bigint",
    "payment_delay": "bigint", "last_interaction": "bigint", "total_spend": "double",
    "gender": "string", "subscription_type": "string", "contract_length": "string",
}


def customer_rows(count=12):
    """Contract-valid rows keyed from 1001 on."""
    rows = []
    for i in range(count):
        rows.append(
            (
                1001 + i, 20 + 3 * i, 1 + i, 5 + i, i % 8, (4 * i) % 30, (2 * i) % 30, 150.0 + 75 * i,
                ("Female", "Male")[i % 2], ("Basic", "Standard", "Premium")[i % 3],
                ("Annual", "Monthly", "Quarterly")[i % 3], i % 2,
            )
        )
    return rows


@pytest.fixture()
def customers(spark):
    schema = "customerid bigint, " + ", ".join(f"{n} {t}" for n, t in FEATURES.items()) + ", churn bigint"
    return spark.createDataFrame(customer_rows(), schema)


def cohort(spark, days, probabilities, classes, labels=None, version=5, extra=None):
    """Scored rows with contract-valid features."""
    base = customer_rows(len(days))
    rows = []
    for i, day in enumerate(days):
        row = (*base[i][1:11], dt.datetime.fromisoformat(day), probabilities[i], classes[i], version)
        rows.append(row if labels is None else (*row, labels[i]))
    schema = ", ".join(f"{n} {t}" for n, t in FEATURES.items())
    schema += ", reference_date timestamp_ntz, predicted_probability double, predicted_class int, model_version int"
    if labels is not None:
        schema += ", churn int"
    return spark.createDataFrame(rows, schema)
