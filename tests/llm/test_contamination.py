import random

import numpy as np
from pyspark.sql import functions as F

from cohorta.llm.contamination import FMIndex, find_contamination, remove_contaminated, suffix_array
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, prose, row, with_extra, words


def brute(text, items, window=13):
    w = words(text)
    hit, found = [False] * len(w), set()
    for item, item_text in items:
        iw = words(item_text)
        if item is None or not iw:
            continue
        n = min(window, len(iw))
        phrases = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in phrases:
                found.add(str(item))
                hit[i : i + n] = [True] * n
    return len(w), sum(hit), sorted(found)


def fixture():
    rng = random.Random(4)
    items = [(k, " ".join(prose(100 + k, rng.choice((1, 4, 12, 13, 14, 40))))) for k in range(12)]
    items += [(12, None), (13, ""), (14, "..."), (None, "lost item text"), (3, items[3][1]), (15, items[5][1])]
    rows = odd_rows()
    for i in range(60):
        w = prose(i, rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            passage = words(rng.choice(items[:12])[1])
            low = rng.randint(0, len(passage) - 1)
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() for x in passage[low : low + rng.randint(1, 40)]]
        rows.append(row(100 + i, rng.choice((" ", ", ", "\n")).join(w)))
    return rows, items


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    for size in (1, 2, 50, 400):
        text = rng.integers(1, 4, size)
        assert suffix_array(np.append(text, 0)).tolist() == sorted(
            range(size + 1), key=lambda i: np.append(text, 0)[i:].tolist()
        )
        index = FMIndex(text, 3)
        phrases = np.array([[a, b] for a in (1, 2, 3) for b in (1, 2, 3)])
        low, high = index.search(phrases)
        for p, lo, hi in zip(phrases.tolist(), low, high, strict=True):
            want = [i for i in range(size - 1) if text[i : i + 2].tolist() == p]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want


def test_against_brute_force_also_in_blocks(spark):
    rows, items = fixture()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block_words in (1_000_000, 30):
        got = find_contamination(docs, bench, block_words=block_words).collect()
        assert len(got) == len(rows)
        assert any(r["n_hit"] for r in got)
        for r in got:
            n, hit, found = brute(r["text"], items)
            assert (r["n_words"], r["n_hit"], r["item_ids"]) == (n, hit, found)
            assert sum(len(words(r["text"][s["start"] : s["end"]])) for s in r["spans"]) == hit


def test_empty_tables_and_extra_columns(spark):
    rows, items = fixture()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    empty = spark.createDataFrame([], SCHEMA)
    assert find_contamination(empty, bench).count() == 0
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}")
    assert remove_contaminated(docs, bench.limit(0)).count() == len(rows)
    kept = remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    want = [r for r in rows if not (b := brute(r[1], items))[1] or 20 * b[1] < b[0]]
    assert 0 < len(want) < len(rows)
    got = kept.select("doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(r[:2]) for r in want)
    assert kept.where(F.col("Spans") != "x").count() == 0
