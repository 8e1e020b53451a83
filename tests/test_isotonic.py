"""Isotonic maps as tables against pooling in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from cohorta.operators import isotonic as I

COUNTS = "k int, score double, pos bigint, neg bigint"


def pooled(rows):
    """Blocks [low, high, hits, weight] of (score, pos, neg) rows of one key."""
    cells = {}
    for s, p, n in rows:
        if s is not None and s == s:
            a, b = cells.get(s, (0, 0))
            cells[s] = a + p, b + p + n
    blocks = []
    for s in sorted(cells):
        if not cells[s][1]:
            continue
        blocks.append([s, s, *cells[s]])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            low, high, hits, weight = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + hits, blocks[-1][3] + weight]
    return [tuple(map(float, b)) for b in blocks]


def value(blocks, s):
    """Rate at a score: linear between blocks, flat beyond the outer ones."""
    if not blocks:
        return None
    before = None
    for low, high, hits, weight in blocks:
        y = hits / weight
        if s < low:
            return y if before is None else before[1] + (y - before[1]) * (s - before[0]) / (low - before[0])
        if s <= high:
            return y
        before = high, y
    return before[1]


def made(seed, shape):
    rng = random.Random(seed)
    rows = []
    for k in (1, 2, None):
        for _ in range(400):
            s = round(rng.random(), 3)
            p = {"rising": s, "falling": 1 - s, "noise": 0.5, "steps": int(s * 4) / 4}[shape]
            hit = rng.random() < p
            rows.append((k, s, int(hit), int(not hit)))
    return rows + [(1, None, 1, 0), (1, float("nan"), 1, 0), (2, 0.5555, 0, 0), (7, 0.3, 2, 5)]


@pytest.mark.parametrize("shape", ["rising", "falling", "noise", "steps"])
def test_blocks_of_many_slices_are_those_of_one_task(spark, shape):
    rows = made(3, shape)
    df = spark.createDataFrame(rows, COUNTS).repartition(4)
    cuts = [i / 23 for i in range(1, 23)]
    got = {}
    for r in I.isotonic_blocks(df, ["k"], cuts).collect():
        got.setdefault(r["k"], []).append((r["low"], r["high"], r["hits"], r["weight"]))
    for k in (1, 2, None, 7):
        assert sorted(got[k]) == pooled([r[1:] for r in rows if r[0] == k])


def test_lookup_of_a_long_map(spark, monkeypatch):
    """Rising rates leave a block for nearly every score; segments spread over many slices."""
    monkeypatch.setattr(I, "SEGMENTS", 4)
    rows = [(1, i / 500, i, 500 - i) for i in range(501)] + [(2, i / 10, i % 3, 3) for i in range(11)]
    maps = I.fit_isotonic_map(spark.createDataFrame(rows, COUNTS), ["k"])
    assert len(maps.cuts) > 50
    asked = [(k, s) for k in (1, 2, 3) for s in (-1.0, 0.0, 0.0013, 0.2, 0.5, 0.77777, 1.0, 5.0)] + [(1, None), (1, float("nan")), (None, 0.5)]
    df = spark.createDataFrame(asked, "k int, score double").withColumn("extra", F.lit("x"))
    got = {(r["k"], repr(r["score"])): r["calibrated"] for r in maps.transform(df).collect()}
    assert len(got) == len(asked)
    for k, s in asked:
        want = None if k not in (1, 2) or s is None or s != s else value(pooled([r[1:] for r in rows if r[0] == k]), s)
        assert got[k, repr(s)] == (want if want is None else pytest.approx(want))


def test_no_rows_and_one_score(spark):
    empty = I.fit_isotonic_map(spark.createDataFrame([], COUNTS), ["k"])
    df = spark.createDataFrame([(1, 0.5)], "k int, score double")
    assert empty.transform(df).collect()[0]["calibrated"] is None
    one = I.fit_isotonic_map(spark.createDataFrame([(1, 0.5, 1, 3)], COUNTS).drop("k"))
    assert [r[0] for r in one.transform(df.union(spark.createDataFrame([(1, -9.0), (1, 9.0)], "k int, score double"))).select("calibrated").collect()] == [0.25] * 3


def test_saved_map(spark, folder):
    rows = [(1, i / 20, i, 20) for i in range(20)]
    maps = I.fit_isotonic_map(spark.createDataFrame(rows, COUNTS), ["k"])
    maps.save(f"{folder}/map")
    again = I.IsotonicMap.load(f"{folder}/map", spark)
    df = spark.createDataFrame([(1, 0.123), (1, 0.77)], "k int, score double")
    assert again.keys == ["k"] and again.transform(df).collect() == maps.transform(df).collect()


def test_few_scores_are_not_cut_up(spark):
    """A border between slices can cost a round of jobs."""
    counts = spark.createDataFrame([(i / 500, i % 3, (i * 7) % 5 + 1) for i in range(500)], "score double, pos bigint, neg bigint")
    whole = I.isotonic_blocks(counts)
    assert whole.select("_slice").distinct().count() == 1
    cut = I.isotonic_blocks(counts, cuts=[0.2, 0.4, 0.6, 0.8])
    columns = ("low", "high", "hits", "weight")
    assert sorted(map(tuple, whole.select(*columns).collect())) == sorted(map(tuple, cut.select(*columns).collect()))
