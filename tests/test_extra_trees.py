"""Extremely randomised trees against a plain-Python grower with the same draws."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohorta.learning.extra_trees import ExtraTrees, ExtraTreesModel, gini_gain, tried


def data(spark, n=300):
    rng = np.random.default_rng(8)
    x = np.column_stack((np.round(rng.normal(size=n), 1), rng.integers(0, 3, n), rng.normal(size=n), np.full(n, 2.0))).astype(float)
    y = (x[:, 0] + x[:, 1] + rng.normal(size=n) * 0.6 > 1).astype(int)
    df = spark.createDataFrame([(i, int(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["i", "label", "features"])
    return x, y, df.repartition(5)


def plain_forest(x, y, trees, seed, least, deepest, wanted):
    """Share of class 1 a row, mean over trees; nodes are numbered level by level as they are made."""
    total = np.zeros(len(y))
    for t in range(trees):
        level, made, depth = [(0, np.arange(len(y)))], 1, 0
        while level:
            after = []
            for node, rows in level:
                whole = np.array([len(rows) - y[rows].sum(), y[rows].sum()])
                best = None
                if whole.min() and len(rows) >= 2 * least and (deepest is None or depth < deepest):
                    for f, cut in tried(seed, t, node, x[rows].min(axis=0), x[rows].max(axis=0), wanted):
                        left = rows[x[rows, f] <= cut]
                        if min(len(left), len(rows) - len(left)) < least:
                            continue
                        gain = gini_gain(np.array([len(left) - y[left].sum(), y[left].sum()]), whole)
                        if best is None or gain > best[0]:
                            best = gain, f, cut
                if best is None:
                    total[rows] += whole[1] / whole.sum()
                    continue
                side = x[rows, best[1]] <= best[2]
                after += [(made, rows[side]), (made + 1, rows[~side])]
                made += 2
            level, depth = after, depth + 1
    return total / trees


@pytest.mark.parametrize("least,deepest,features", [(1, None, "sqrt"), (8, 4, None)])
def test_as_a_plain_grower(spark, least, deepest, features):
    x, y, df = data(spark)
    model = ExtraTrees(labelCol="label", n_estimators=3, min_samples_leaf=least, max_depth=deepest, max_features=features, random_state=5).fit(df)
    rows = model.transform(df).orderBy("i").select(vector_to_array("probability")[1]).collect()
    want = plain_forest(x, y, 3, 5, least, deepest, 2 if features else 4)
    assert [r[0] for r in rows] == pytest.approx(want.tolist())


def test_constant_features_saving_and_no_rows(spark, folder):
    _, _, df = data(spark, 40)
    flat = df.withColumn("features", F.lit(None)).drop("features").crossJoin(spark.createDataFrame([(Vectors.dense([1.0, 1.0]),)], ["features"]))
    model = ExtraTrees(labelCol="label", n_estimators=2).fit(flat)
    assert {len(t["feature"]) for t in model.fitted()["trees"]} == {1}
    model.write().overwrite().save(f"{folder}/m")
    assert ExtraTreesModel.load(f"{folder}/m").fitted() == model.fitted()
    with pytest.raises(ValueError):
        ExtraTrees(labelCol="label").fit(df.limit(0))


def test_jobs_of_a_fit_do_not_grow_with_the_partitions(spark):
    _, _, df = data(spark, 60)
    held = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.sparkContext.setJobGroup("extra-trees-jobs", "")
    try:
        model = ExtraTrees(labelCol="label", n_estimators=2, max_depth=3).fit(df)
    finally:
        spark.sparkContext.setJobGroup("other", "")
        for name, value in held.items():
            spark.conf.set(name, value)
    assert max(len(t["feature"]) for t in model.fitted()["trees"]) > 3
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("extra-trees-jobs")) < 40


@pytest.mark.parametrize("least,deepest", [(1, None), (8, 4)])
def test_the_driver_holds_no_forest(spark, monkeypatch, least, deepest):
    """Trees are in a table, of several parts here; rows that do not fit a task give the same trees, one held at a time."""
    from cohorta.learning import extra_trees

    monkeypatch.setattr(extra_trees, "NODES", 30)
    monkeypatch.setattr(extra_trees, "SENT_BYTES", 1_000)
    x, y, df = data(spark)
    fit = lambda: ExtraTrees(labelCol="label", n_estimators=3, min_samples_leaf=least, max_depth=deepest, random_state=5).fit(df)
    whole = fit()
    assert set(whole.getOrDefault(whole.state)) == {"path", "count"}
    held = []
    real = extra_trees.Forest.__init__
    monkeypatch.setattr(extra_trees.Forest, "__init__", lambda self, count, number=0: (held.append(count), real(self, count, number))[0])
    monkeypatch.setattr(extra_trees, "TASK_BYTES", 0)
    by_level = fit()
    assert held == [1, 1, 1]
    assert by_level.fitted()["trees"] == whole.fitted()["trees"]
    want = plain_forest(x, y, 3, 5, least, deepest, 2)
    for model in (whole, by_level):
        rows = model.transform(df).orderBy("i").select(vector_to_array("probability")[1]).collect()
        assert [r[0] for r in rows] == pytest.approx(want.tolist())
