"""Leaf-wise boosting against a plain-Python trainer."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohorta.learning.boosting import Growing, Histograms, HistogramBoosting, HistogramBoostingModel, bin_cuts


def data(spark, seed=3, n=500):
    rng = np.random.default_rng(seed)
    x = np.column_stack((np.round(rng.normal(size=n), 1), rng.integers(0, 7, n), rng.normal(size=n), rng.integers(0, 2, n))).astype(float)
    signal = x[:, 0] + (x[:, 1] > 3) * 1.5 - x[:, 3] * x[:, 0] + rng.normal(size=n) * 0.7
    y = (signal > 0.5).astype(int)
    df = spark.createDataFrame([(int(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"])
    return x, y, df.repartition(5)


def plain_trainer(x, y, rounds, rate, leaves, least, penalty, depth=None):
    """Best-first trees by scanning every cut of every leaf; raw scores of the rows."""
    raw = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    cuts = [(lambda v: (v[1:] + v[:-1]) / 2)(np.unique(x[:, f])) for f in range(x.shape[1])]

    def best(rows, g, h):
        whole = g[rows].sum() ** 2 / (h[rows].sum() + penalty + 1e-15)
        top = None
        for f, borders in enumerate(cuts):
            for c in borders:
                a, b = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if min(len(a), len(b)) < least or min(h[a].sum(), h[b].sum()) < 1e-3:
                    continue
                gain = g[a].sum() ** 2 / (h[a].sum() + penalty + 1e-15) + g[b].sum() ** 2 / (h[b].sum() + penalty + 1e-15) - whole
                if gain > 1e-12 and (top is None or gain > top[0] * (1 + 1e-9)):
                    top = gain, a, b
        return top

    sizes = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        open_ = [(np.arange(len(y)), 0)]
        found = [best(open_[0][0], g, h)]
        while len(open_) < leaves:
            can = [i for i in range(len(open_)) if found[i] and (depth is None or open_[i][1] < depth)]
            if not can:
                break
            i = max(can, key=lambda j: found[j][0])
            _, a, b = found[i]
            d = open_[i][1] + 1
            open_[i : i + 1] = [(a, d), (b, d)]
            found[i : i + 1] = [best(a, g, h), best(b, g, h)]
        for rows, _ in open_:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + penalty + 1e-15)
        sizes.append(sorted(len(rows) for rows, _ in open_))
    return raw, sizes


@pytest.mark.parametrize("settings", [{}, {"l2_regularization": 5.0, "max_leaf_nodes": 4}, {"max_depth": 2, "min_samples_leaf": 40}])
def test_as_a_plain_trainer(spark, settings):
    x, y, df = data(spark)
    model = HistogramBoosting(labelCol="label", max_iter=4, learning_rate=0.3, max_bins=600, write_every=2, **settings).fit(df)
    want, sizes = plain_trainer(
        x, y, 4, 0.3, settings.get("max_leaf_nodes", 31), settings.get("min_samples_leaf", 20), settings.get("l2_regularization", 0.0), settings.get("max_depth")
    )
    rows = model.transform(df).select("features", vector_to_array("rawPrediction")[1].alias("m")).collect()
    got = {tuple(r["features"]): r["m"] for r in rows}
    assert [got[tuple(a)] for a in x] == pytest.approx(want.tolist())
    assert [sorted(n for n, f in zip(t["rows"], t["feature"]) if f < 0) for t in model.fitted()["trees"]] == sizes
    if "max_leaf_nodes" in settings:
        assert max(sum(f < 0 for f in t["feature"]) for t in model.fitted()["trees"]) == 4


def test_bins(spark):
    rows = spark.createDataFrame([([float(i % 4), float(i), 7.0],) for i in range(400)], "x array<double>").repartition(3)
    few, many, one = bin_cuts(rows, 3, 16)
    assert few == [0.5, 1.5, 2.5] and one == []
    assert len(many) == 15 and all(abs(c - 25 * (k + 1)) <= 12.5 for k, c in enumerate(many))


def test_sibling_is_parent_less_child():
    rng = np.random.default_rng(0)
    parent, child = rng.random((3, 2, 5)) + 1, rng.random((3, 2, 5))
    assert Histograms(parent - child).h == pytest.approx(Histograms(parent).h - Histograms(child).h)


def test_best_first_takes_the_largest_gain():
    """Growth asks for the children of what it may split, and splits by gain, not by level."""
    grown = Growing({"max_leaf_nodes": 3, "max_depth": None, "min_samples_leaf": 1, "l2_regularization": 0.0}, [[0.5]])
    grown.split = [(9.0, 0, 0, 1), (1.0, 0, 0, 1), (5.0, 0, 0, 1)]
    grown.left, grown.right = [1, -1, -1], [2, -1, -1]
    assert grown.first_splits() == ([0, 2], [2])


def test_one_class_and_saving(spark, folder):
    _, _, df = data(spark, n=120)
    with pytest.raises(ValueError):
        HistogramBoosting(labelCol="label").fit(df.where("label = 1"))
    model = HistogramBoosting(labelCol="label", max_iter=2).fit(df)
    model.write().overwrite().save(f"{folder}/m")
    again = HistogramBoostingModel.load(f"{folder}/m")
    pick = lambda m: m.transform(df).agg(F.sum(vector_to_array("probability")[1])).first()[0]
    assert pick(again) == pytest.approx(pick(model))


def test_blocks_of_a_partition_and_trees_gone_through(spark, monkeypatch):
    """A task has one block of rows, and a job goes through fewer than four trees that are not in the raw scores yet."""
    from cohorta.learning import boosting

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    files, pending = set(), set()
    real = boosting.node_histograms

    def watched(blocks, trees, *rest):
        files.add(len(blocks.inputFiles()))
        pending.add(len(trees))
        return real(blocks, trees, *rest)

    monkeypatch.setattr(boosting, "node_histograms", watched)
    rows = [(Vectors.dense(i % 7, i % 31), int(i % 7 + i % 5 > 5)) for i in range(400)]
    data = spark.createDataFrame(rows, ["features", "label"])
    HistogramBoosting(labelCol="label", max_iter=6, max_leaf_nodes=3).fit(data)
    assert max(files) >= 8
    assert max(pending) < 4


def test_the_registered_query_grows_all_trees(monkeypatch):
    """Nothing but the alias is given, so the fit has its default rounds."""
    from registered import learning

    given = []
    monkeypatch.setattr(learning, "_train", lambda spark, sf_dir, *args, **params: given.append((args, params)))
    learning.train_hgb_score(None, "")
    assert given == [(("hgb",), {})]
