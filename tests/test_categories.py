"""Categories kept in a table: the numbers and vectors of the listed ones, for any number of labels."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from cohorta.contracts import CHURN
from cohorta.learning.categories import CategoryTable, number_labels
from cohorta.learning.pipelines import fit_pipeline

WORDS = ["b", "a", "B", "é", "", " a", "zz", "a", None, "b", "10", "9", "a\u0000", "\U0001f600", "\uffee"]


def test_numbers_follow_the_byte_order(spark):
    df = spark.createDataFrame([(w, w and w[::-1]) for w in WORDS] * 3, "v string, w string").repartition(5)
    got = {(r["column"], r["label"]): r["number"] for r in number_labels(df, ["v", "w"]).collect()}
    for column, words in (("v", WORDS), ("w", [w and w[::-1] for w in WORDS])):
        want = sorted({w for w in words if w is not None}, key=lambda w: w.encode())
        assert [got[column, w] for w in want] == list(range(len(want)))
    assert len(got) == 2 * len({w for w in WORDS if w is not None})


def test_vectors_equal_the_listed_ones(spark):
    # Spark's encoder refuses an empty listed label, and orders its labels by UTF-16 units
    words = [w for w in WORDS if w and all(ord(c) < 0xD800 for c in w)]
    train = spark.createDataFrame([(w, str(len(w))) for w in words], "v string, w string")
    rows = spark.createDataFrame([(w, "1", 7) for w in words] + [("unseen", "?", 7), ("a", "1", 8)] * 2, "v string, w string, _number int")
    names, hot = ["iv", "iw"], ["hv", "hw"]
    tail = [OneHotEncoder(inputCols=names, outputCols=hot, dropLast=True), VectorAssembler(inputCols=hot, outputCol="x")]
    listed = StringIndexer(inputCols=["v", "w"], outputCols=names, handleInvalid="keep", stringOrderType="alphabetAsc")
    vectors = []
    for first in (listed, CategoryTable(["v", "w"], names)):
        scored = Pipeline(stages=[first, *tail]).fit(train).transform(rows.drop("_number"))
        vectors.append(sorted((r["v"], r["w"], tuple(r["x"].toArray())) for r in scored.collect()))
    assert vectors[0] == vectors[1]
    assert sum(sum(x) == 0 for *_, x in vectors[1]) == 2


def test_odd_columns(spark):
    empty = spark.createDataFrame([], "v string")
    model = CategoryTable(["v"], ["i"]).fit(empty)
    assert model.sizes == {"v": 0}
    rows = spark.createDataFrame([("a",), (None,)], "v string")
    assert [r["i"] for r in model.transform(rows).collect()] == [0.0, 0.0]
    nulls = CategoryTable(["v"], ["i"]).fit(rows)
    assert {r["v"]: r["i"] for r in nulls.transform(rows).collect()} == {"a": 0.0, None: 1.0}
    assert nulls.transform(rows.withColumn("i", F.lit("old"))).columns == ["v", "i"]
    with pytest.raises(ValueError):
        CategoryTable(["v"], [])


def test_a_hundred_thousand_labels_fit(spark):
    """The fitted stage holds a path and a count; a third of the rows share one label."""
    count = 100_000
    rows = spark.range(150_000).select(
        F.when(F.col("id") < count, F.format_string("label-%06d", "id")).otherwise("label-000007").alias("v"),
        ((F.col("id") % 3) == 0).cast("double").alias("y"),
    )
    model = CategoryTable(["v"], ["i"]).fit(rows)
    assert model.sizes == {"v": count} and len(str(model.fitted())) < 1000
    numbered = model.transform(rows)
    check = numbered.agg(F.count_if(F.col("i") != F.substring("v", 7, 6).cast("double")), F.countDistinct("i"), F.count("*")).first()
    assert tuple(check) == (0, count, 150_000)
    hot = OneHotEncoder(inputCol="i", outputCol="features", dropLast=True).fit(numbered).transform(numbered)
    fitted = LogisticRegression(labelCol="y", maxIter=2, regParam=0.1).fit(hot)
    assert fitted.coefficients.size == count and np.isfinite(fitted.coefficients.toArray()).all()


def test_pipelines_agree(spark, customers):
    rows = customers.withColumn("churn", F.col("churn").cast("int"))
    scores = {}
    for kind in ("list", "table"):
        fitted, _ = fit_pipeline(CHURN, "lr", {}, rows, categories=kind)
        odd = rows.unionByName(rows.limit(2).withColumns({"gender": F.lit("?"), "customerid": F.col("customerid") + 5000}))
        scores[kind] = {r["customerid"]: r["p"] for r in fitted.score(odd, "p").collect()}, fitted.names_out
    assert scores["list"][1] == scores["table"][1]
    assert scores["list"][0] == pytest.approx(scores["table"][0], abs=1e-6) and len(scores["table"][0]) == 14
    with pytest.raises(ValueError):
        fit_pipeline(CHURN, "lr", {}, rows, categories="other")
