import math
import random
from collections import Counter

from cohorta.llm.common import load
from cohorta.llm.quality import FIRST, estimate, judge, measures, votes
from tests.conftest import SF
from tests.llm.odd import EXTRA, SCHEMA, SPACE_WORD, odd_rows, row, with_extra


def brute(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            twice += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), twice, len(covered), failed


def test_measures_against_brute_force(spark):
    rng = random.Random(2)
    texts = ["", "a", "a b", "a b c", "a b c a b c", " \t\n x\x0by\x0cz\r x y z ", "a b c b c d a b c b c d", "a a a a a",
             "x\n\nx\n \n \n", "é 😀 é 😀 é 😀", "# *$%&|<> |", "a b a b a b c"]
    texts.append(" ".join([f"w{i}" for i in range(200)] * 2 + ["x"] * 9))  # more repeated windows than are looked up
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    rows = odd_rows() + [row(100 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}").repartition(2)
    got = judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((r[0], *brute(r[1])) for r in rows)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert judge(docs.limit(0)).count() == 0


def brute_estimate(patterns, rules, rounds=40, close=1e-4):
    good, rates = 0.85, dict.fromkeys(rules, FIRST)

    def posterior(p):
        odds = math.log(good / (1 - good))
        for rule in rules:
            share = {k: (*rates[rule][k], 1 - sum(rates[rule][k])) for k in "gb"}
            vote = 2 if p[rule] is None else p[rule]
            odds += math.log(share["g"][vote] / share["b"][vote])
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        weigh = [(p, p["n"] * posterior(p)) for p in patterns]
        size = {"g": sum(g for _, g in weigh), "b": sum(p["n"] - g for p, g in weigh)}
        after = {
            rule: {
                k: tuple(
                    (sum(g if k == "g" else p["n"] - g for p, g in weigh if p[rule] == vote) + 1) / (size[k] + 3)
                    for vote in (0, 1)
                )
                for k in "gb"
            }
            for rule in rules
        }
        good = min(0.99, max(0.01, size["g"] / (size["g"] + size["b"])))
        moved = max(abs(x - y) for r in rules for k in "gb" for x, y in zip(after[r][k], rates[r][k], strict=True))
        rates = after
        if moved < close:
            break
    return posterior


def test_estimation_against_plain_python(spark):
    rng = random.Random(3)
    rules = list(votes())[:4]
    rows = [(*[rng.choice((0, 1, None)) for _ in rules], rng.randint(1, 50)) for _ in range(25)]
    df = spark.createDataFrame(rows, ", ".join(f"{r} int" for r in rules) + ", n bigint")
    want = brute_estimate([dict(zip([*rules, "n"], r, strict=True)) for r in rows], rules)
    model = estimate(df, rules)
    for r in df.withColumn("p", model.posterior()).collect():
        assert math.isclose(r["p"], want(r.asDict()), rel_tol=1e-6, abs_tol=1e-9)


def test_verdicts_agree_with_labels(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    judged = judge(docs).join(labels, "doc_id").where("NOT base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.02 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.1 * counts[0, False]


def test_undefined_measures_abstain(spark):
    rules = votes()
    (r,) = measures(spark.createDataFrame([(1, None)], "doc_id int, text string")).select(
        *[v.alias(k) for k, v in rules.items()]
    ).collect()
    assert set(r) == {None}


def test_words_with_symbols_are_counted(spark):
    """More than a tenth of the words with a symbol is a bad vote, whatever lines they are in."""
    texts = ["", "a b", "#a b# c#d#e\n## \x0b#\tf $", "# " * 9, "a#\r\x0c#b 😀#é |", "a\nb\nc\nd\ne\nf\ng #h #i", "#a " + "b " * 9 + "c"]
    rows = [row(i, t) for i, t in enumerate(texts)]
    got = measures(spark.createDataFrame(rows, SCHEMA)).select("*", votes()["clean_words"].alias("v")).collect()
    for r in got:
        w = SPACE_WORD.findall(texts[r["doc_id"]])
        marked = sum(any(c in "#*$%&|<>" for c in x) for x in w)
        assert r["n_marked"] == marked
        assert r["v"] == (0 if 10 * marked > len(w) else None)
