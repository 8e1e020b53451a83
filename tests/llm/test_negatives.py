"""Hard negatives against a brute-force version, and the walk over sorted lists alone."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.llm import negatives as N
from cohorta.llm.queries import op11_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3):
    """Every (anchor, positive) with its negatives, from all pairs."""
    part = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i % 7 == 0:
            label = (label + 1) % 10
        part.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for i, v, label in part:
        if i % 50:
            continue
        dot = lambda w: sum(a * b for a, b in zip(v, w))
        own = sorted(((-dot(w), j) for j, w, other in part if other == label and j != i))[:positives]
        rest = sorted((-dot(w), j) for j, w, other in part if other != label and j != i)
        for p, j in own:
            fit = [(s, k) for s, k in rest if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(i, j, n, k, -p, -s) for n, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def made(seed, n, dims=8, labels=4, spread=0.5, coarse=None):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centre[label] * 0.3 + rng.normal(size=dims) * spread
        v = np.float32(np.round(v * coarse) / coarse if coarse else v)
        rows.append((i, [float(x) for x in v], label))
    return rows


def mined(spark, tables, rows, schema=SCHEMA):
    return sorted(map(tuple, op11_hard_negatives(spark, tables(embeddings=(rows, schema))).collect()))


@pytest.mark.parametrize("coarse", [None, 2])
def test_as_all_pairs(spark, tables, monkeypatch, coarse):
    """Several blocks and chunks; coarse components give many equal scores."""
    rows = made(3, 420, coarse=coarse)
    monkeypatch.setattr(N.mine, "__defaults__", (*N.mine.__defaults__[:-2], 64, 4))
    want = brute(rows)
    assert len(want) > 30
    assert mined(spark, tables, rows) == want


def test_odd_rows(spark, tables):
    rows = made(5, 160, dims=3)
    rows += [
        (50, None, 1), (None, [1.0, 2.0, 3.0], 1), (100, [1.0, 0.0, 0.0], None), (101, [float("nan"), 0.0, 0.0], 1),
        (102, [float("inf"), 0.0, 0.0], 1), (103, [None, 0.0, 0.0], 1), (104, [], 1), (105, [0.5], 2), (150, [], 3),
        (200, [0.0, 0.0, 0.0], 2), (250, [0.5, 0.5, 0.5, 0.5, 0.5], 2),
    ]
    rows += rows[40:60]  # repeated rows, an anchor among them
    assert mined(spark, tables, rows) == brute(rows)


def test_extra_columns_empty_and_one_label(spark, tables):
    wide = SCHEMA + ", id string, parts int, anchor string, block int, score string, window int"
    rows = made(7, 120, dims=4)
    assert mined(spark, tables, [(*r, "x", 1, "y", 2, "z", 3) for r in rows], wide) == brute(rows)
    assert mined(spark, tables, []) == []
    same = [(i * 100 + 1, v, 1) for i, v, _ in rows] + [(50, [1.0] * 4, 1)]
    assert mined(spark, tables, same) == brute(same)


def test_huge_components_do_not_overflow(spark, tables):
    rows = [(50, [3e38, -3e38], 1), (51, [3e38, 1.0], 1), (52, [1e38, 1.0], 2), (53, [2.0, 1.0], 2), (54, [1.0, 3e38], 1)]
    got = mined(spark, tables, rows)
    assert all(r[0] == 50 and 50 * r[4] <= 100 * r[5] <= 95 * r[4] for r in got)


def test_walk_stops_early_and_is_exact():
    """On one strong dimension the threshold falls below the third score long before the lists end."""
    rng = np.random.default_rng(1)
    parts = rng.integers(-3, 4, size=(4000, 6))
    parts[:, 2] = rng.integers(-30_000, 30_000, size=4000)
    ids = rng.permutation(4000)
    lists = N.Lists(ids.astype(np.int64), parts, 6)
    met = []
    whole = N.Lists.exact

    class Seen(np.ndarray):
        def __getitem__(self, key):
            met.append(len(key))
            return np.asarray(self)[key]

    def exact(self, anchor):
        rows, point = whole(self, anchor)
        return rows.view(Seen), point

    lists.exact = exact.__get__(lists)
    anchor = np.array([1, -1, -50, 1, 0, 1])
    scores = parts @ anchor
    low, high = np.array([-(10**12), 0]), np.array([10**12, 10**6])
    got = lists.walk(anchor, low, high, 3)
    for w in range(2):
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if low[w] <= s <= high[w])[:3]
        assert got[w] == [(-s, i) for s, i in want]
    assert 0 < sum(met) < 4000


def test_general_parameters(spark):
    """Another number of positives and negatives, other percentages, another choice of anchors."""
    rows = made(11, 200, dims=5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = N.mine(df, F.col("vec_id") < 3, positives=2, negatives=4, least=10, most=80).collect()
    assert got and {r["anchor_id"] for r in got} <= {0, 1, 2} and max(r["rank"] for r in got) <= 4
    assert all(10 * r["positive_score"] <= 100 * r["negative_score"] <= 80 * r["positive_score"] for r in got)


def test_anchors_are_not_broadcast(spark, tables, monkeypatch):
    """Only the numbers of the blocks go through the driver, however small the planner takes the written chunks to be."""
    rows = made(13, 600)
    monkeypatch.setattr(N, "WAVE", 2)
    monkeypatch.setattr(N.mine, "__defaults__", (*N.mine.__defaults__[:-2], 64, 3))
    found = op11_hard_negatives(spark, tables(embeddings=(rows, SCHEMA)))
    assert sorted(map(tuple, found.collect())) == brute(rows)
    plans = []
    real = N._visits

    def watched(*args):
        df = real(*args)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(N, "_visits", watched)
    op11_hard_negatives(spark, tables(embeddings=(rows, SCHEMA)))
    assert len(plans) == 2
    for plan in plans:
        lines = plan.splitlines()
        sent = [lines[i + 1] for i, line in enumerate(lines) if "BroadcastExchange" in line]
        assert len(sent) == 1 and "a_parts" not in sent[0] and "parts" not in sent[0]
