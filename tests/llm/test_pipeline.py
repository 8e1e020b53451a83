from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohorta.llm import queries
from cohorta.llm.common import load
from tests.conftest import SF
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, row, with_extra
from tests.llm.test_contamination import brute as brute_hits
from tests.llm.test_near_copies import brute_classes


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage got and gave over the smallest tables, with more columns and odd rows."""
    docs = load(spark, SF, "documents")
    odd = [(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in odd_rows() if r[0] not in (6, 7)]
    rows = [tuple(r) for r in docs.collect()] + odd
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_go_through(steps):
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns


def test_language_keeps_clean_documents(steps):
    _, before, after = steps[0]
    gone = before.select("text").exceptAll(after.select("text")).collect()
    assert {r["text"] for r in gone} <= {r[1] for r in odd_rows()}
    assert after.where("text IS NULL").count() == 0


def test_no_line_is_left_twice(steps):
    _, _, after = steps[1]
    lines = after.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("length(line) >= 20").distinct()
    assert lines.groupBy("line").count().where("count > 1").count() == 0
    assert after.where("n_chars != length(text)").count() == 0


def test_one_document_of_each_class_is_left(steps):
    _, before, after = steps[2]
    rows = [tuple(r)[:2] for r in before.collect()]
    classes = {t: c for (_, t), c in zip(rows, brute_classes(rows), strict=True)}
    left = Counter(classes[r["text"]] for r in after.select("text").distinct().collect())
    assert left == Counter(set(classes.values()))


def test_contaminated_documents_are_gone(steps, spark):
    _, before, after = steps[3]
    items = [tuple(r) for r in load(spark, SF, "benchmark", "item_id", "text").collect()]
    clean = []
    for r in before.select("doc_id", "text").collect():
        n, hit, _ = brute_hits(r["text"], items)
        if not hit or 20 * hit < n:
            clean.append(tuple(r))
    assert Counter(map(tuple, after.select("doc_id", "text").collect())) == Counter(clean)


def test_tokens_decode_to_the_text(steps):
    _, before, after = steps[4]
    assert after.columns == ["doc_id", "token_ids", "n_tokens", "round_trip"]
    assert after.where("NOT round_trip").count() == 0 and after.count() == before.count()


def test_run_over_empty_and_odd_tables(spark, tables):
    bench = ([(1, "some item")], "item_id bigint, text string")
    assert corpus_pipeline.run(spark, tables(documents=([], SCHEMA), benchmark=bench)).count() == 0
    some = tables(documents=(odd_rows()[:6] + [row(77, "the same of it " * 9)], SCHEMA), benchmark=([], bench[1]))
    assert corpus_pipeline.run(spark, some).count() > 0


def test_every_operator_has_one_query():
    numbers = [name.split("_")[0] for name in queries.QUERIES]
    assert sorted(numbers) == sorted(f"op{n}" for n in range(1, 11))
    assert public_tokenizers.path(corpus_pipeline.RANKS)
