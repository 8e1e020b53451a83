import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cohorta.llm.common import held_out, load
from cohorta.llm import language as L
from cohorta.llm.language import UNKNOWN, KernelModel, _points, fit, grams, keep_known_languages, predict
from tests.conftest import SF
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, row, with_extra


def test_held_out_accuracy(spark):
    docs = load(spark, SF.replace("0.001", "0.01"), "documents")
    model = fit(docs.where(~held_out("doc_id", 3)))
    test = docs.where(held_out("doc_id", 3))
    scored = predict(test, model)
    assert scored.where("lang = lang_pred").count() >= 0.97 * test.count()
    assert scored.where("score < 0 OR score > 1").count() == 0


def test_kernel_is_presence_over_geometric_mean():
    model = KernelModel(["abc", "xyz", "abd"], ["a", "x", "a"], 5, 1e-3)
    # 1- to 3-grams of abc and abd: a, b, ab in common of six each
    own = grams(model.codes[_points("abd")])
    row_ = model._present(own) @ model.landmarks / np.sqrt(len(own))
    assert np.allclose(sorted(row_), [0, 0.5, 1])


def test_odd_rows_and_unknown(spark):
    rows = odd_rows() + [row(50 + i, t, la) for i, (t, la) in enumerate([("der die das und", "de"), ("the of and to", "en")] * 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    found = {(r["doc_id"], r["text"]): r for r in predict(docs, fit(docs)).collect()}
    for (_, text), r in found.items():
        lettered = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] == UNKNOWN) == (not lettered)
        assert r["lang_pred"] in {"en", "de", UNKNOWN} and 0 <= r["score"] <= 1
    assert found[50, "der die das und"]["lang_pred"] == "de"
    # nothing to learn from
    none = fit(docs.limit(0))
    assert {r["lang_pred"] for r in predict(docs, none).collect()} == {UNKNOWN}
    assert predict(docs.limit(0), none).count() == 0


def test_stage_keeps_clean_documents(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}")
    model = fit(docs)
    kept = keep_known_languages(docs, model)
    assert kept.columns == docs.columns
    ids = [r["text"] for r in kept.select("text").collect()]
    assert None not in ids and "!!! ??? 123" not in ids
    assert rows[0][1] in ids


def test_lang_and_source_are_no_inputs(spark):
    docs = load(spark, SF, "documents")
    model = fit(docs.where(~held_out("doc_id", 3)))
    swapped = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a = predict(docs, model).select("doc_id", "lang_pred", "score")
    b = predict(swapped, model).select("doc_id", "lang_pred", "score")
    assert a.exceptAll(b).count() == 0


def test_every_letter_counts_as_itself():
    """Scripts with far more letters than an alphabet has are told apart by single letters."""
    kanji, hangul = [chr(0x4E00 + i) for i in range(400)], [chr(0xAC00 + i) for i in range(400)]
    texts = ["".join(kanji[i : i + 40]) for i in range(0, 400, 40)] + ["".join(hangul[i : i + 40]) for i in range(0, 400, 40)]
    model = KernelModel(texts, ["zh"] * 10 + ["ko"] * 10, 10, 1e-3)
    names, _ = model.predict(pa.array(["".join(kanji[5:300:7]), "".join(hangul[3:350:9])]))
    assert names == ["zh", "ko"]


def test_texts_are_looked_at_some_at_a_time(monkeypatch):
    texts = ["der die das und " * k for k in range(1, 40)] + [None, ""] + ["the of and to " * k for k in range(40, 1, -1)]
    model = KernelModel([t for t in texts if t], ["de"] * 39 + ["en"] * 39, 8, 1e-3)
    whole = model.predict(pa.array(texts))
    monkeypatch.setattr(L, "AT_ONCE", 64)
    some = model.predict(pa.array(texts))
    assert whole[0] == some[0] == ["de"] * 39 + [UNKNOWN] * 2 + ["en"] * 39
    assert np.allclose(whole[1], some[1], atol=1e-6)


def test_only_the_commonest_languages_are_learned(spark):
    rows = [row(i, f"word{'abcdefgh'[i % 8]} of number {i}", "abcdefgh"[i % 8] if i < 40 else "a") for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert fit(docs, languages=3).langs == ["a", "b", "c"]


def test_memory_of_a_block_is_that_of_a_few_texts():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(8)
    texts = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 900)) for _ in range(40)]
    model = KernelModel(texts, ["a", "b"] * 20, 20, 1e-3)
    column = pa.array(["a few words"] * 256)
    tracemalloc.start()
    model.predict(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 128 * 4 * len(model.features)
