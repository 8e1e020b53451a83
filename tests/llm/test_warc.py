import base64
import hashlib
import random

import pytest

from cohorta.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        smallest = first.get(html or "")
        again = smallest is not None and smallest != i
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if again else "response", smallest if again else None))
    return sorted(out, key=repr)


def pages():
    rng = random.Random(2)
    fake = warc.record("77", "http://x", "inner", "1", False)
    rows = []
    for i in range(120):
        html = [
            None,
            "",
            "x" * rng.randint(0, 4000),
            "a WARC/1.0\r\n b" + "y" * rng.randint(0, 3000),
            fake + "\r\n\r\n" + fake,
            "same",
            "é\r\n\r\nWARC/1.0\r\nWARC/1.0\r\n" * rng.randint(1, 4) + str(rng.randint(0, 5)),
        ][i % 7]
        rows.append((None if i == 50 else i, [None, "http://a b\r\nc", "u"][i % 3], html))
    return [*rows, (5, "u", "same"), (5, "u", "same"), (None, None, None)]


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_round_trip_over_many_splits_with_magics_inside_payloads(spark, small_splits):
    rows = pages()
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_small_payloads_are_never_revisits(spark):
    rows = pages()[:40]
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA), least_bytes=5).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, 5)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, "u", "h", "x", 2)], f"{SCHEMA}, payload string, sha1 int")
    assert [r["page_id"] for r in warc.round_trip(df).collect()] == [1]


def test_bytes_that_no_chain_reaches_are_no_records(spark, folder):
    good = warc.record("1", "u", "one", None, False) + "\r\n\r\n"
    # junk between the records breaks the chain; a file that starts with junk has none
    spark.createDataFrame([(good + "junk" + good,)], "v string").coalesce(1).write.text(f"{folder}/a")
    spark.createDataFrame([("junk" + good,)], "v string").coalesce(1).write.text(f"{folder}/b")
    assert [r["record_id"] for r in warc.read_archives(spark, f"{folder}/a").collect()] == ["1"]
    assert warc.read_archives(spark, f"{folder}/b").count() == 0
