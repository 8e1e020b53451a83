"""Tables of one row a model version meet the rows without a shuffle of these."""

from cohorta.operators import drift as D
from cohorta.plans import views as V
from tests.conftest import SF

TIME = "reference_date"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark):
    reference, analysis = V.scored_cohorts(spark, SF)
    lit = D.F.lit
    return reference.withColumn("period", lit("reference")).withColumn("source", lit("batch")), analysis


def test_reconstruction_errors_need_no_shuffle(spark):
    reference, _ = rows(spark)
    model = D.ReconstructionDrift(V.RETURNS.feature_columns, TIME).fit(reference)
    assert "SortMergeJoin" not in plan(model.row_errors(reference))


def test_bin_counts_shuffle_counts_only(spark, monkeypatch):
    reference, _ = rows(spark)
    monkeypatch.setattr(D, "materialize", lambda df, label: df)
    found = D.bin_counts(reference, ["quantity", "discount"], ["line_status"], ["source", "period", "model_version", TIME])
    assert "SortMergeJoin" not in plan(found)
