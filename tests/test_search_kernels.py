"""Guided search against random draws, and the radial kernel against exact ones."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array

from cohorta.learning.catalog import CATALOG, create_classifier
from cohorta.learning.kernels import FourierFeatures, directions, fourier
from cohorta.learning.parzen import STARTUP, Choices, Range, guided_draw
from cohorta.learning.tuning import draw

SPACE = {
    "rate": {"type": "float", "low": 1e-4, "high": 1e2, "log": True},
    "depth": {"type": "int", "low": 1, "high": 60, "log": False},
    "kind": {"type": "categorical", "choices": [None, "a", "b", 3]},
}


def worth(p):
    return -((math.log10(p["rate"]) + 2) ** 2) - ((p["depth"] - 17) / 10) ** 2 - (p["kind"] != "b")


def best(seed, trials, guided):
    generator, done = random.Random(seed), []
    for k in range(trials):
        p = guided_draw(SPACE, done, generator) if guided and k >= STARTUP else draw(SPACE, generator)
        done.append((p, worth(p)))
    return max(s for _, s in done)


def test_guided_draws_beat_random_ones_at_equal_trials():
    guided = [best(s, 50, True) for s in range(100)]
    plain = [best(s, 50, False) for s in range(100)]
    assert np.mean(guided) > np.mean(plain) and sum(g > p for g, p in zip(guided, plain)) > 50


def test_guided_draws_follow_the_space_and_the_seed():
    for alias, entry in CATALOG.items():
        generator = random.Random(alias)
        done = [(draw(entry["space"], generator), score) for score in (0.5, None, float("nan"), 0.7, 0.7)]
        for name, value in guided_draw(entry["space"], done, generator).items():
            part = entry["space"][name]
            assert value in part["choices"] if part["type"] == "categorical" else part["low"] <= value <= part["high"]
    done = [(draw(SPACE, random.Random(k)), float(k)) for k in range(12)]
    assert guided_draw(SPACE, done, random.Random(1)) == guided_draw(SPACE, done, random.Random(1))


def test_densities_are_densities():
    part = Range([0.2, 0.2, 0.9], 0.0, 1.0)
    grid = np.linspace(0, 1, 2001)
    assert np.mean([math.exp(part.log_density(x)) for x in grid]) == pytest.approx(1, abs=0.02)
    assert part.log_density(0.2) > part.log_density(0.55)
    assert sum(math.exp(Choices(["a", "a"], [None, "a"]).log_density(c)) for c in (None, "a")) == pytest.approx(1)


def ring(n=240, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    return x, (np.hypot(x[:, 0], x[:, 1]) > 1.1).astype(int)


def test_inner_products_are_the_kernel(spark):
    x, _ = ring(60)
    df = spark.createDataFrame([(i, Vectors.dense(a)) for i, a in enumerate(x)], ["i", "features"])
    model = FourierFeatures(3, 4096).fit(df)
    rows = model.transform(df).orderBy("i").select(vector_to_array("fourier")).collect()
    z = np.array([r[0] for r in rows])
    gamma = model.fitted()["gamma"]
    assert gamma == pytest.approx(1 / (2 * x.var()))
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).mean() < 0.02


def exact_margin(x, y, c, gamma, rounds=300):
    """Kernel hinge loss by ascent on the dual, one row at a time; the constant is a kernel of ones."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2)) + 1
    s = np.where(y == 1, 1.0, -1.0)
    a = np.zeros(len(y))
    for _ in range(rounds):
        for i in range(len(y)):
            a[i] = min(max(a[i] + (1 - s[i] * (k[i] @ (a * s))) / k[i, i], 0), c)
    return k @ (a * s)


def test_margin_is_near_the_exact_kernel_machine(spark):
    x, y = ring()
    df = spark.createDataFrame([(i, int(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["i", "label", "features"])
    estimator, config = create_classifier("svc", {"C": 1.0, "components": 1024}, "label", len(y))
    model = estimator.fit(df)
    rows = model.transform(df).orderBy("i").select(vector_to_array("rawPrediction")[1]).collect()
    got = np.array([r[0] for r in rows])
    want = exact_margin(x, y, 1.0, 1 / (2 * x.var()))
    assert np.mean((got > 0) == (want > 0)) > 0.95 and np.corrcoef(got, want)[0, 1] > 0.97
    assert np.mean((got > 0) == (y == 1)) > 0.93
    assert config["model_name"] == "LinearSVC" and config["kernel"] == "rbf"
    with pytest.raises(ValueError, match="poly"):
        create_classifier("svc", {"kernel": "poly"}, "label", 5)


def test_features_of_a_batch_need_little_more_than_their_own_memory():
    import tracemalloc

    rows = np.random.default_rng(3).normal(size=(6000, 9))
    state = {"seed": 4, "width": 9, "components": 256, "gamma": 0.3}
    given = pa.array(list(rows), pa.list_(pa.float64()))
    tracemalloc.start()
    found = fourier(state, given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    along, phase = directions(state)
    assert np.allclose(np.stack(found.to_pylist()), np.cos(rows @ along + phase) * np.sqrt(2 / 256))
    assert peak < 1.3 * len(rows) * 256 * 8
    assert len(fourier(state, given[:0])) == 0
