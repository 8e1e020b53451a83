"""Aliases whose versions were assigned at one time."""

import pytest

from cohorta.operators.promotion import current_aliases, resolve_models


@pytest.mark.parametrize("order", [(7, 3, 9, 5), (9, 7, 5, 3), (3, 5, 7, 9)])
def test_versions_assigned_at_one_time(spark, order):
    rows = [("m", "champion", version, 4) for version in order] + [("m", "champion", 11, 2)]
    history = spark.createDataFrame(rows, "model_name string, alias string, model_version int, assigned_at bigint")
    assert [tuple(r) for r in current_aliases(history.coalesce(1)).collect()] == [("m", "champion", 9, 4)]
    versions = spark.createDataFrame(
        [("m", v, f"run-{v}", "churn", 0.5) for v in order], "model_name string, model_version int, run_id string, use_case string, threshold double"
    )
    asked = spark.createDataFrame([("m", "churn", "champion", None)], "model_name string, use_case string, alias string, model_version int")
    assert resolve_models(asked, versions, history).first()["run_id"] == "run-9"
