import random
from bisect import bisect_left
from collections import Counter

import numpy as np

from cohorta.llm.near_copies import aligned, keep_one_of_each, labelled_shingles, near_duplicates
from cohorta.llm.words import find_words
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, prose, row, with_extra, words


def sequence(text):
    w = words(text)
    k, seen, out = min(5, len(w)), Counter(), []
    for i in range(len(w) - k + 1 if w else 0):
        s = tuple(w[i : i + k])
        out.append((s, seen[s]))
        seen[s] += 1
    return out


def similarity(a, b):
    place, tails = {x: i for i, x in enumerate(b)}, []
    for x in a:
        if x in place:
            k = bisect_left(tails, place[x])
            tails[k : k + 1] = [place[x]]
    return len(tails) / (len(a) + len(b) - len(tails)) if a and b else 0


def brute_classes(rows):
    """Class of each row by comparing all texts: equal texts, equal words, or similarity of 0.8."""
    texts = sorted({t for _, t, *_ in rows if t is not None})
    seqs = {t: sequence(t) for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            small, large = sorted((len(seqs[a]), len(seqs[b])))
            if small and small >= 0.8 * large and similarity(seqs[a], seqs[b]) >= 0.8:
                parent[find(a)] = find(b)
    return [find(t) if t is not None else None for _, t, *_ in rows]


def fixture():
    rng = random.Random(8)
    rows = odd_rows()
    for g in range(25):
        base = prose(g, rng.choice((3, 5, 8, 12, 30, 90, 200, 400)))
        for c in range(rng.choice((1, 2, 6))):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                k, at = rng.randint(0, 2), rng.randint(0, len(w) - 1)
                w[at : at + (k > 0)] = [] if k == 2 and len(w) > 1 else [rng.choice(("xq", "zv", "wk"))]
            text = (" ", ", ")[c % 2].join(w)
            rows.append(row(1000 + 10 * g + c, text.upper() if c == 3 else text))
    return rows


def test_alignment_is_the_longest_common_order():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.sample(range(40), rng.randint(1, 30))
        b = [x for x in a if rng.random() < 0.95] + rng.sample(range(40, 50), rng.randint(0, 3))
        if rng.random() < 0.3:
            i = rng.randint(0, len(b) - 1) if b else 0
            b = b[i:] + b[:i]
        want = similarity(a, b)
        got = aligned(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == (want if want >= 0.8 else 0)


def test_shingles_have_no_repeats():
    for text in ("a a a a a a a a a a", "a b c d e f a b c d e f a b c d e", "x", ""):
        blob = np.frombuffer(text.encode(), np.uint8)
        got = labelled_shingles(find_words(blob, np.array([0, len(blob)])).hashes)
        assert len(set(got.tolist())) == len(got) == len(sequence(text))


def test_classes_against_all_pairs(spark):
    rows = fixture()
    got = near_duplicates(spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}").repartition(3)).collect()
    assert len(got) == len(rows)
    want = brute_classes(rows)
    members = {}
    for r, c in zip(rows, want, strict=True):
        if c is not None:
            members.setdefault(c, set()).add(r[0])
    named = {c: min(m, key=lambda i: (i is None, i or 0)) for c, m in members.items()}
    expected = Counter((r[0], r[0] if c is None else named[c]) for r, c in zip(rows, want, strict=True))
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == expected
    assert len({repr(c) for c in want}) < len(rows) - 20


def test_one_of_each_class_stays(spark):
    rows = fixture()
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.select("doc_id", "text").collect()
    classes = {t: c for (_, t, *_), c in zip(rows, brute_classes(rows), strict=True)}
    nulls = sum(t is None for _, t, *_ in rows)
    assert sum(r["text"] is None for r in got) == nulls
    # rows that repeat id and text stay together
    assert Counter(classes[t] for t in {r["text"] for r in got if r["text"] is not None}) == Counter(
        {c for c in classes.values() if c is not None}
    )


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
