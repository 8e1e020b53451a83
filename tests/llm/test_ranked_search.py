"""Ranked search against a brute-force version over all documents and items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cohorta.llm import ranked_search as R
from cohorta.llm.queries import op13_ranked_search
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, row, with_extra

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = "item_id bigint, text string"


def terms(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scores, wanted = [], terms(text)
        for i, w in held:
            tf = Counter(w)
            m = 100 - 25 + 25 * len(w) * n // total
            s = sum(weight[t] * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in wanted if t in tf)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k, None if z else i, -s) for k, (s, z, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def found(spark, tables, docs, items, schema=SCHEMA):
    folder = tables(documents=(docs, schema), benchmark=(items, ITEM))
    return sorted((tuple(r) for r in op13_ranked_search(spark, folder).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x9"]
    texts = [" ".join(rng.choice(words[: rng.choice((5, 20, 63))]) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    return [row(rng.randrange(10**6), t) for t in texts], words, rng


def test_as_all_pairs(spark, tables):
    docs, words, rng = corpus(1, 300)
    docs += [row(10**7 + k, docs[0][1]) for k in range(60)]  # one class of many copies
    docs += [row(2 * 10**7 + k, " ".join(reversed(docs[1][1].split()))) for k in range(30)]  # equal bags, other texts
    docs += [row(3 * 10**7 + k, docs[0][1] + " unlisted" * k) for k in range(30)]  # equal terms, other lengths
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for k in range(25)]
    items += [(90, docs[0][1]), (91, "w1 W1 w1"), (92, "zzz"), (93, "unlisted,w3;w4")]
    assert found(spark, tables, docs, items) == brute([r[:2] for r in docs], items)


def test_odd_rows(spark, tables):
    docs = odd_rows()
    items = [(1, "the cat"), (1, "the mat"), (None, "cat"), (2, None), (3, ""), (4, "A"), (5, "日本語 ünïcode 123"), (6, docs[9][1])]
    want = brute([r[:2] for r in docs], items)
    assert found(spark, tables, docs, items) == want
    assert found(spark, tables, with_extra(docs), items, f"{SCHEMA}, {EXTRA}") == want


def test_empty_tables_and_weightless_terms(spark, tables):
    docs = [row(k, "all") for k in range(5)]
    assert found(spark, tables, [], [(1, "a")]) == []
    assert found(spark, tables, docs, []) == []
    assert found(spark, tables, [row(1, None), row(2, "--")], [(1, "a")]) == []
    assert found(spark, tables, docs, [(1, "all")]) == brute([r[:2] for r in docs], [(1, "all")])


def test_blocks_of_items_give_the_same(spark, tables, monkeypatch):
    docs, words, rng = corpus(2, 120)
    items = [(k, " ".join(rng.choice(words) for _ in range(6))) for k in range(30)]
    monkeypatch.setattr(R, "VOCABULARY", 40)
    assert found(spark, tables, docs, items) == brute([r[:2] for r in docs], items)


def test_pieces_cut_no_term(monkeypatch):
    text = " ".join("Wörter und words"[: k % 17] for k in range(500)) + "x" * 300
    monkeypatch.setattr(R, "PIECE", 64)
    pieces = list(R.terms(text))
    assert len(pieces) > 10 and [t.decode() for p in pieces for t in p] == terms(text)


@pytest.mark.parametrize("cells", [1, 7, 1 << 22])
def test_items_are_scored_some_at_a_time(monkeypatch, cells):
    monkeypatch.setattr(R, "CELLS", cells)
    bags = [(np.array([1, 4], np.int32), np.array([2, 1])), (np.array([0], np.int32), np.array([1])), (np.array([1, 2, 3], np.int32), np.array([1, 1, 5]))]
    weights = np.array([10, 20, 30, 40, 50])
    rows = [(80, np.array([0, 1, 4], np.int32), np.array([1, 2, 3])), (75, np.array([2], np.int32), np.array([1]))]
    share = lambda tf, m: 10**9 * tf // (1000 * tf + 12 * m)
    want = [
        [2 * 20 * share(2, 80) + 50 * share(3, 80), 10 * share(1, 80), 20 * share(2, 80)],
        [0, 0, 30 * share(1, 75)],
    ]
    got = np.zeros((2, 3), np.int64)
    for first, used, matrix in R.Items({}, bags).parts():
        got[:, first : first + matrix.shape[1]] = R.class_scores(matrix, used, weights, rows)
    assert got.tolist() == want


def test_scores_past_exact_doubles():
    """Products that doubles cannot hold exactly are made of whole numbers."""
    matrix, used = np.array([[10**7]]), np.array([0], np.int32)
    weights = np.array([15_013])
    (score,) = R.class_scores(matrix, used, weights, [(75, np.array([0], np.int32), np.array([7]))])[0].tolist()
    assert score == 10**7 * 15_013 * (7 * 10**9 // (7000 + 12 * 75))
