"""Quality by weak supervision, with DataFrame functions only.

Rules look at word, line and character statistics of a whole text. Each votes good or bad, or abstains
where its measure says little. How far each rule is to be believed is not set by hand: expectation
maximisation over the counts of the vote patterns estimates the share of good documents and, for
every rule, how often it votes good, votes bad or abstains on good and on bad documents, which is
its accuracy on either. A document is kept if its
posterior probability of being good is at least one half. There are three to the power of the number
of rules patterns at most, whatever the corpus; every estimation step is an aggregate over them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch

WHITE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
FEW = 64  # repeated windows a text is searched for one by one; either way gives the same positions
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row of counts a document, from its whole text; a null text counts as empty.

    Equal windows of three words are found by 64-bit hashes inside one document: in sorted order, equal
    neighbours are repeated windows, and the positions of these in order give the words they cover. Nothing is exploded or shuffled, and the work is n log n in the words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    cut = base.select(
        "doc_id",
        "t",
        F.array_remove(F.split("t", WHITE), "").alias("w"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("l"),
    )
    counted = cut.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count_of(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _count_of(F.col("t"), UPPER).cast("long").alias("n_upper"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
        # from a word's first symbol to its end is one match: words that hold a symbol, without trying every word
        F.when(F.col("t").rlike("[#*$%&|<>]"), F.regexp_count("t", F.lit("[#*$%&|<>][^\\x20\\x09-\\x0D]*")))
        .otherwise(0)
        .cast("long")
        .alias("n_marked"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("l", lambda line: line.rlike("[.!?:;,\"'][\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_ended"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.when(
            F.size("w") >= 3,
            F.transform(
                F.arrays_zip(
                    F.slice("w", F.lit(1), F.size("w") - 2),
                    F.slice("w", F.lit(2), F.size("w") - 2),
                    F.slice("w", F.lit(3), F.size("w") - 2),
                ),
                lambda s: F.xxhash64(s["0"], s["1"], s["2"]),
            ),
        ).alias("h"),
    )
    # only texts with a repeated window go on; sorted hashes show which windows these are
    ordered = counted.withColumn("o", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array("h")))
    twice = ordered.withColumn(
        "d",
        F.array_distinct(
            F.filter(
                F.zip_with("o", F.slice("o", F.lit(2), F.size("o")), lambda a, b: F.when(a == b, a)),
                lambda x: x.isNotNull(),
            )
        ),
    ).drop("o")
    # a few repeated windows are looked up; many are sorted together with all positions
    few = F.size("d") <= FEW
    looked_up = F.filter(
        F.transform("h", lambda x, i: F.when(F.array_contains("d", x), i)), lambda i: i.isNotNull()
    )
    pairs = twice.withColumn(
        "s",
        F.when(F.size("d") > FEW, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))),
    ).withColumn("m", F.when(few, looked_up))
    none = F.lit(None).cast("struct<x:bigint,i:int>")
    neighbours = F.arrays_zip(
        F.col("s"),
        F.concat(F.array(none), F.slice("s", F.lit(1), F.size("s") - 1)),
        F.concat(F.slice("s", F.lit(2), F.size("s")), F.array(none)),
    )
    side_by_side = F.sort_array(
        F.transform(
            F.filter(
                neighbours,
                lambda z: z["s"]["x"].eqNullSafe(z["1"]["x"]) | z["s"]["x"].eqNullSafe(z["2"]["x"]),
            ),
            lambda z: z["s"]["i"],
        )
    )
    marked = pairs.drop("h", "d").withColumn("m", F.coalesce("m", F.when(F.col("s").isNotNull(), side_by_side))).drop("s")
    # every window covers three words, fewer where the next one begins
    covered = F.aggregate(
        F.zip_with("m", F.slice("m", F.lit(2), F.size("m")), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return marked.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("m")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    """1, 0 or null; a measure that is missing abstains."""
    return F.when(value.isNull(), None).when(bad, 0).when(good, 1)


def votes() -> dict[str, Column]:
    """The rules over the measures."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    lines = F.when(F.col("n_lines") > 0, F.col("n_lines"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    mean, symbols, upper = F.col("word_chars") / words, F.col("n_symbols") / words, F.col("n_upper") / chars
    repeats, twice = F.col("n_repeat_words") / words, F.col("n_dup_lines") / lines
    ended, kinds = F.col("n_ended") / lines, F.col("n_distinct") / words
    marked, shouts = F.col("n_marked") / words, F.col("n_shouts") / words
    never = F.lit(False)
    return {
        "lines_end": _vote(ended, ended >= 0.6, ended < 0.2),
        "many_words": _vote(kinds, kinds >= 0.3, kinds < 0.15),
        "word_length": _vote(mean, mean.between(3, 10), (mean < 2) | (mean > 14)),
        "few_symbols": _vote(symbols, never, symbols > 0.1),
        "clean_words": _vote(marked, never, marked > 0.1),
        "few_capitals": _vote(upper, never, upper > 0.3),
        "few_shouts": _vote(shouts, never, shouts > 0.1),
        "few_repeats": _vote(repeats, never, repeats > 0.3),
        "few_equal_lines": _vote(twice, never, twice > 0.3),
    }


@dataclass
class LabelModel:
    """Share of good documents; per rule the shares of good and bad votes among good and bad ones."""

    good: float
    rates: dict[str, dict[str, tuple[float, float]]]

    def posterior(self) -> Column:
        """Probability that a document with these votes is good."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, rate in self.rates.items():
            ratio = {k: math.log(rate["g"][k] / rate["b"][k]) for k in (0, 1)}
            none = math.log((1 - sum(rate["g"])) / (1 - sum(rate["b"])))
            odds = odds + F.when(F.col(rule) == 1, ratio[1]).when(F.col(rule) == 0, ratio[0]).otherwise(none)
        return 1 / (1 + F.exp(-odds))


def _between(x: float, low: float, high: float) -> float:
    return min(high, max(low, x))


#: (bad, good) votes of a rule among good and among bad documents, before anything is known
FIRST = {"g": (0.03, 0.5), "b": (0.3, 0.3)}


def estimate(patterns: DataFrame, rules: list[str], rounds: int = 40, close: float = 1e-4) -> LabelModel:
    """Expectation maximisation over pattern counts (the rules' columns and n).

    The first guess takes rules to vote bad more often on bad documents, which tells the two classes
    apart. Every share is smoothed by one vote of each kind. Without documents the first guess stays.
    """
    model = LabelModel(0.85, dict.fromkeys(rules, FIRST))
    for _ in range(rounds):
        weighed = patterns.withColumn("g", F.col("n") * model.posterior()).withColumn("b", F.col("n") - F.col("g"))
        sums = [F.sum("g").alias("g"), F.sum("b").alias("b")]
        for rule in rules:
            sums += [
                F.sum(F.when(F.col(rule) == vote, F.col(kind))).alias(f"{rule}_{kind}_{vote}")
                for kind in "gb"
                for vote in (0, 1)
            ]
        got = {k: v or 0.0 for k, v in weighed.agg(*sums).first().asDict().items()}
        total = got["g"] + got["b"]
        if not total:
            break
        rates = {
            rule: {
                kind: tuple((got[f"{rule}_{kind}_{vote}"] + 1) / (got[kind] + 3) for vote in (0, 1)) for kind in "gb"
            }
            for rule in rules
        }
        after = LabelModel(_between(got["g"] / total, 0.01, 0.99), rates)
        moved = max(
            abs(x - y)
            for rule in rules
            for kind in "gb"
            for x, y in zip(rates[rule][kind], model.rates[rule][kind], strict=True)
        )
        model = after
        if moved < close:
            break
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, votes, base_failed, posterior and kept of every row.

    Null and empty texts have no words and fail the base rules, as does everything under 50 words;
    rules whose measure is undefined abstain; repeated rows count as often as they occur; an empty
    table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rules = votes()
    voted = scratch.keep(
        measures(docs, id_col, text_col).select("*", *[v.cast("int").alias(k) for k, v in rules.items()]), "votes"
    )
    # what the base rules reject needs no verdict, and would only be learned as the bad class
    judged = voted.where(~base_failed())
    patterns = scratch.keep(judged.groupBy(*rules).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    model = estimate(patterns, list(rules))
    return voted.withColumn("base_failed", base_failed()).withColumn("posterior", model.posterior()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)
    )
