import zlib
from collections import Counter, defaultdict

import numpy as np

from cohorta.llm.common import load
from cohorta.llm.shards import assign_shards, pack
from tests.conftest import SF
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, row, with_extra


def check_slots(got, shards):
    for s in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_balance_and_groups(spark):
    docs = load(spark, SF.replace("0.001", "0.01"), "documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = assign_shards(docs, 8, slice_rows=100).collect()
    check_slots(got, 8)
    assert len(got) == len(text)
    for column in ("bytes", "tokens"):
        sums = Counter()
        for r in got:
            sums[r["shard"]] += r[column]
        assert max(sums.values()) <= 1.03 * min(sums.values())
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 3
    places = defaultdict(set)
    for r in got:
        raw = text[r["doc_id"]].encode()
        assert (r["bytes"], r["text_crc32"], r["tokens"]) == (len(raw) + 1, zlib.crc32(raw), len(raw.split()))
        places[raw].add(r["shard"])
    assert all(len(p) == 1 for p in places.values())


def test_hot_group_is_split(spark):
    rows = [row(i, "the same text in a third of all rows " * 5) for i in range(400)]
    rows += [row(1000 + i, f"text {i} " * 20) for i in range(800)]
    got = assign_shards(spark.createDataFrame(rows, SCHEMA), 8).collect()
    check_slots(got, 8)
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["bytes"]
    assert max(sums.values()) <= 1.1 * min(sums.values())


def test_highest_dot_product_wins():
    # the last item has no bytes, so it goes where most tokens are left
    sizes = np.array([[8.0, 1.0], [1.0, 8.0], [0.0, 0.5]])
    place = pack(sizes, 2)
    assert place[0] != place[1] and place[2] == place[0]


def test_odd_rows(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}")
    got = assign_shards(docs, 3).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["bytes"]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1) for i, t, *_ in rows
    )
    check_slots(got, 3)
    assert assign_shards(docs.limit(0), 3).count() == 0
