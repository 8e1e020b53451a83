import random

from cohorta.llm.common import Scratch
from cohorta.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    links += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    parent = {n: n for link in links for n in link}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {n: find(n) for a, b in links if a != b for n in (a, b)}
    got = components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark, "t"), "c")
    rows = got.collect()
    assert len(rows) == len(want) and {r["node"]: r["root"] for r in rows} == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark, "t"), "c").count() == 0
