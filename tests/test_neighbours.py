"""Which pairs of a block are compared feature by feature."""

import numpy as np
import pyarrow as pa
import pytest

from cohorta.learning.neighbours import _candidates


@pytest.mark.parametrize("k,bounded", [(5, True), (5, False), (2_500, False)])
def test_few_pairs_are_compared_and_no_neighbour_is_lost(k, bounded):
    rng = np.random.default_rng(4)
    among, at = np.round(rng.normal(size=(3_000, 6)) + 1e3, 2), np.round(rng.normal(size=(40, 6)) + 1e3, 2)
    plain = np.zeros((40, 3_000))
    for j in range(6):
        plain += (at[:, j, None] - among[None, :, j]) ** 2
    plain = np.sqrt(plain)
    last = np.partition(plain, k - 1, axis=1)[:, k - 1]
    i, j, distance = _candidates(at, among, last if bounded else np.full(40, np.inf), k)
    found = np.full(plain.shape, np.inf)
    found[i, j] = distance
    inside = plain <= last[:, None]
    assert (found[inside] == plain[inside]).all()
    assert len(i) <= max(plain.size / 10, 1.2 * inside.sum())


def test_a_batch_visits_few_leaves(monkeypatch):
    """Queries that lie together are compared with the points near them, and no neighbour is lost."""
    from cohorta.learning import neighbours as N

    rng = np.random.default_rng(6)
    among, at = np.round(rng.random((6_000, 3)), 2) * [50, 20, 1], np.round(rng.random((300, 3)), 2) * [50, 20, 1]
    compared = []
    real = N._candidates
    monkeypatch.setattr(N, "_candidates", lambda a, b, *rest: (compared.append(len(a) * len(b)), real(a, b, *rest))[1])
    monkeypatch.setattr(N, "LEAF", 32)
    plain = np.sqrt(sum((at[:, f, None] - among[None, :, f]) ** 2 for f in range(3)))
    for k, bound in ((5, np.inf), (5, 1.0), (40, np.inf)):
        compared.clear()
        queries = pa.table({"q": np.arange(300), "x": list(at), "bound": np.full(300, bound)})
        ones = np.ones(6_000, np.int64)
        got = N._nearest(k)(queries, pa.table({"x": list(among), "n": ones, "pos": np.arange(6_000) % 2})).to_pydict()
        found = {}
        for q, distance, n, pos in zip(*got.values()):
            found.setdefault(q, []).append((distance, n, pos))
        for q in range(300):
            last = min(np.sort(plain[q])[k - 1], bound)
            values = sorted(set(plain[q][plain[q] <= last].tolist()))
            want = [(v, int((plain[q] == v).sum()), int((np.flatnonzero(plain[q] == v) % 2).sum())) for v in values]
            assert found.get(q, []) == want
        assert sum(compared) < plain.size / 4


def test_cells_halve_the_points():
    from cohorta.learning import neighbours as N

    x = np.random.default_rng(7).normal(size=(1_000, 4)) * [1, 9, 3, 1]
    cuts = N.cell_cuts(x, 3)
    assert len(cuts) == 7 and cuts[0][0] == 1
    assert np.bincount(N.cells_of(x, cuts)).tolist() == [125] * 8
