import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohorta.llm import recurrent as lm
from cohorta.llm.common import held_out, load
from tests.conftest import SF
from tests.llm.odd import EXTRA, FOLD, SCHEMA, SPACE_WORD, odd_rows, with_extra


def tokens(text):
    return [*SPACE_WORD.findall((text or "").translate(FOLD)), None]


def vocab_of(texts):
    counts = Counter(w.encode() for t in texts for w in tokens(t)[:-1])
    order = sorted(counts, key=lambda w: (-counts[w], w))[: lm.SHORTLIST]
    rare, kinds = np.zeros(lm.SHAPES), np.zeros(lm.SHAPES)
    for w in counts:
        if w not in order:
            rare[lm.shape(w)] += counts[w]
            kinds[lm.shape(w)] += 1
    return lm.Vocabulary(
        {w: math.log10(c + 0.5) for w, c in counts.items()},
        {w: i for i, w in enumerate(order)},
        np.array([counts[w] for w in order], float),
        rare,
        kinds,
        len(texts),
        sum(counts.values()) + len(texts),
        len(counts) + 1,
    )


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    vocab = vocab_of(["a b c d e f g a b", "b c d x y"])
    w = {k: v.astype(np.float64) for k, v in lm.first_weights(vocab).items()}
    steps, lanes = 5, 3
    inputs = rng.integers(0, 10, (steps, lanes))
    targets = np.where(rng.random((steps, lanes)) < 0.5, rng.integers(0, 9, (steps, lanes)), lm.MEMBERS + 3)
    live = rng.random((steps, lanes)) < 0.9
    fresh = rng.random((steps, lanes)) < 0.2
    fresh[0] = True

    def loss(w):
        state, total = np.zeros((lanes, lm.HIDDEN)), 0.0
        classes, places = lm._targets(targets, len(w["ww"]))
        for t in range(steps):
            state = lm._step(w, w["x"][inputs[t]], np.where(fresh[t][:, None], 0, state))[0]
            p = lm._softmax(state @ w["wc"] + w["bc"])[np.arange(lanes), classes[t]]
            for i in range(lanes):
                if classes[t, i] < len(w["ww"]):
                    g = classes[t, i]
                    p[i] *= lm._softmax(state[i : i + 1] @ w["ww"][g] + w["bw"][g])[0, places[t, i]]
            total -= np.log(p)[live[t]].sum()
        return total / live.sum()

    grad, _ = lm.train_window(w, np.zeros((lanes, lm.HIDDEN)), inputs, targets, live, fresh)
    for name in w:
        at = np.unravel_index(np.argsort(-np.abs(grad[name]).ravel())[:3], w[name].shape)
        for place in zip(*at, strict=True):
            moved = {k: v.copy() for k, v in w.items()}
            moved[name][place] += 1e-5
            up = loss(moved)
            moved[name][place] -= 2e-5
            assert math.isclose((up - loss(moved)) / 2e-5, grad[name][place], rel_tol=2e-2, abs_tol=1e-5)


def test_classes_and_words_make_a_distribution():
    vocab = vocab_of(["a b c d e f g a b", "b c d x y"])
    w = lm.first_weights(vocab)
    ends = [np.array([0, s], np.int32) for s in [*range(len(vocab.numbers)), *range(lm.MEMBERS, lm.MEMBERS + lm.SHAPES), vocab.end]]
    first = lm.score_chunk(w, [np.array([0], np.int32)], vocab.end)[0]
    assert math.isclose(sum(10 ** (s - first) for s in lm.score_chunk(w, ends, vocab.end)), 1, rel_tol=1e-4)


def test_state_is_carried_through_whole_documents():
    rng = np.random.default_rng(2)
    vocab = vocab_of(["a b c d e f g a b", "b c d x y"])
    w = lm.first_weights(vocab)
    docs = [rng.integers(0, 9, n).astype(np.int32) for n in (1, 2, 700, 3, 90, 49, 48)]
    together = lm.score_chunk(w, docs, vocab.end)
    for doc, got in zip(docs, together, strict=True):
        state, total, before = np.zeros((1, lm.HIDDEN), np.float32), 0.0, vocab.end
        for symbol in doc:
            state = lm._step(w, w["x"][[before]], state)[0]
            (g,), (place,) = lm._targets(np.array([symbol]), vocab.groups)
            total += np.log(lm._softmax(state @ w["wc"] + w["bc"])[0, g])
            total += np.log(lm._softmax(state @ w["ww"][g] + w["bw"][g])[0, place])
            before = symbol
        assert math.isclose(got, total / math.log(10), rel_tol=1e-4)


def check_base(rows, got, learned):
    counts = Counter(w for r, k in zip(rows, learned, strict=True) if k for w in tokens(r[1]))
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for r in rows:
        w = tokens(r[1])
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        want[r[0], len(w), sum(counts[x] > 0 for x in w), total, round(base, 4)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want


def test_base_score_of_odd_rows(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}").repartition(2)
    got = lm.score(docs, ~held_out("doc_id", 5)).collect()
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", held_out("doc_id", 5).alias("h")).collect()}
    check_base(rows, got, [not held[r[0]] for r in rows])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    # nothing to learn from
    check_base(rows, lm.score(docs, F.lit(False)).collect(), [False] * len(rows))
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0


def test_held_out_documents_are_likelier_than_by_unigrams(spark):
    docs = load(spark, SF.replace("0.001", "0.01"), "documents")
    got = lm.score(docs, ~held_out("doc_id", 5)).where(held_out("doc_id", 5))
    sums = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert sums["s"] > 0.985 * sums["b"]


def test_every_share_is_learned_from(spark):
    """Documents of any share change the network, those with a null id too."""
    vocab = vocab_of(["a b c d e f g a b"] * 20)
    shares = spark.range(200).select("id", F.pmod(F.xxhash64("id"), F.lit(lm.EVERY)).alias("s"))
    ids = {r["s"]: r["id"] for r in shares.collect()}
    for i in (None, *(ids[s] for s in range(2, lm.EVERY, 3))):
        docs = spark.createDataFrame([(i, "a b c d e f g a b")] * 20, "doc_id bigint, text string").coalesce(1)
        assert not np.array_equal(lm.train(docs, vocab, "doc_id", "text")["u"], lm.first_weights(vocab)["u"])


def test_size_of_the_model():
    w = lm.first_weights(vocab_of(["a b c"]))
    assert w["u"].shape == (32, 96) and w["wc"].shape == (32, 1 + 64 + 1)
