"""Language identification by string kernels.

The kernel is the blended-spectrum presence kernel: the number of letter n-grams (n = 1 to 3) two
texts have in common, over the geometric mean of their own numbers. Landmark texts span a Nyström
feature space; one-versus-rest kernel ridge regression is solved in it. A block of documents is
scored by two matrix products: presence of the landmarks' n-grams times the landmarks, then the
kernel values times the weights.

Only the fit uses a sample: of the `languages` commonest labels at most `per_language` texts each, of at most
`longest` characters, chosen by a hash of the id. Every letter of any script counts as itself, and every document
is scored on its whole text, some texts at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch, schema_with, text_bytes, without

UNKNOWN = "und"
NO_LETTER = 1  # code of a character that is no letter; a letter's code is its lower-case code point and 2 more
WIDTH = 21  # bits of a character's code in an n-gram
BLOCK = 64  # texts scored by one matrix product
AT_ONCE = 1 << 20  # bytes of texts, or characters of one text, looked at together
LANDMARKS = 1024  # of all languages together
RESULT = "lang_pred string, score double"


def letter_codes() -> np.ndarray:
    """Code of every code point."""
    codes = np.full(0x110000, NO_LETTER, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            codes[point] = ord(c.lower()[0]) + 2
    return codes


def grams(codes: np.ndarray) -> np.ndarray:
    """Numbers of the distinct 1- to 3-grams of one text, sorted."""
    found = np.zeros(0, np.int64)
    for at in range(0, len(codes), AT_ONCE):
        one = codes[at : at + AT_ONCE + 2].astype(np.int64)
        two = one[:-1] << WIDTH | one[1:]
        three = two[:-1] << WIDTH | one[2:]
        new = np.unique(np.concatenate((one, two, three)))
        found = np.union1d(found, new) if len(found) else new
    return found


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _some_texts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about AT_ONCE bytes at most; a longer text is alone."""
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + AT_ONCE, side="right")) - 1
        high = min(max(high, low + 1), low + BLOCK)
        yield low, high
        low = high


class KernelModel:
    """Landmarks' n-grams, and the weights of each language over the kernel values."""

    def __init__(self, texts: list[str], langs: list[str], per_language: int, ridge: float):
        number = Counter(langs)
        self.langs = sorted(number)
        self.codes = letter_codes()
        per_language = max(1, min(per_language, LANDMARKS // max(1, len(number))))
        if not self.langs:
            return
        sets = [grams(self.codes[_points(t)]) for t in texts]
        roots = np.sqrt([len(s) for s in sets])
        seen = dict.fromkeys(self.langs, 0)
        chosen = []
        for i, lang in enumerate(langs):
            if seen[lang] < per_language:
                seen[lang] += 1
                chosen.append(i)
        self.features = np.unique(np.concatenate([sets[i] for i in chosen]))
        self.landmarks = np.zeros((len(self.features), len(chosen)), np.float32)
        for j, i in enumerate(chosen):
            self.landmarks[np.searchsorted(self.features, sets[i]), j] = 1 / roots[i]
        kernel = np.stack([self._present(s) @ self.landmarks / r for s, r in zip(sets, roots, strict=True)]).astype(float)
        inner = kernel[chosen]  # landmarks against landmarks
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        good = values > 1e-6 * values[-1]
        self.whiten = vectors[:, good] / np.sqrt(values[good])
        features = np.column_stack((kernel @ self.whiten, np.ones(len(texts))))
        wanted = np.where(np.array(langs)[:, None] == np.array(self.langs)[None], 1.0, -1.0)
        # every language weighs the same, however common it is
        weight = np.array([1 / number[lang] for lang in langs])[:, None]
        left = features.T @ (features * weight) + ridge * np.eye(features.shape[1])
        solved = np.linalg.solve(left, features.T @ (wanted * weight))
        self.weights = (self.whiten @ solved[:-1]).astype(np.float32)
        self.offset = solved[-1].astype(np.float32)

    def _present(self, found: np.ndarray) -> np.ndarray:
        """Which of the landmarks' n-grams are among these."""
        own = np.zeros(len(self.features), np.float32)
        at = np.searchsorted(self.features, found)
        at[at == len(own)] = 0
        own[at[self.features[at] == found]] = 1
        return own

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text; memory is that of some texts, or of the longest."""
        blob, offsets = text_bytes(column)
        names, scores = [UNKNOWN] * len(column), np.zeros(len(column))
        if not self.langs:
            return names, scores
        for low, high in _some_texts(offsets):
            part = blob[offsets[low] : offsets[high]]
            codes = self.codes[_points(part.tobytes().decode())]
            before = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80, dtype=np.int64)))[offsets[low : high + 1] - offsets[low]]
            present = np.zeros((high - low, len(self.features)), np.float32)
            roots = np.ones(high - low, np.float32)
            letters = np.zeros(high - low, bool)
            for i in range(high - low):
                text = codes[before[i] : before[i + 1]]
                letters[i] = (text != NO_LETTER).any()
                if letters[i]:
                    found = grams(text)
                    roots[i] = np.sqrt(len(found))
                    present[i] = self._present(found)
            kernel = (present @ self.landmarks) / roots[:, None]
            del present  # before the next block's is made
            margin = kernel @ self.weights + self.offset
            best = margin.argmax(axis=1)
            for i in np.flatnonzero(letters).tolist():
                names[low + i] = self.langs[best[i]]
                scores[low + i] = min(1.0, max(0.0, (float(margin[i, best[i]]) + 1) / 2))
        return names, scores


def sample(
    labelled: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int, longest: int, languages: int
) -> DataFrame:
    """At most per_language texts of each of the commonest languages, first in hash order; no language is sorted whole."""
    usable = labelled.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= longest)
    ).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    counts = Scratch(labelled.sparkSession, "language").keep(
        usable.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(languages), "counts"
    )
    spread = 1 << 30
    place = F.pmod(F.xxhash64("i", F.lit(7)), F.lit(spread))
    # four times as many as asked for pass the threshold, so a language's sort stays bounded
    # the languages go to the texts, so that only texts under the threshold are shuffled
    near = usable.join(F.broadcast(counts), "l").where(place * F.col("n") <= F.lit(4.0 * per_language * spread))
    order = W.partitionBy("l").orderBy(F.xxhash64("i", F.lit(7)), F.col("i"), F.md5("t"))
    return near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).select("t", "l", "k")


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = 300,
    landmarks: int = 24,
    longest: int = 20_000,
    ridge: float = 1e-3,
    languages: int = 200,
) -> KernelModel:
    """Model over the bounded sample; without labelled texts it knows no language."""
    rows = sample(labelled, text_col, lang_col, id_col, per_language, longest, languages).toLocalIterator()
    rows = sorted(rows, key=lambda r: (r["l"], r["k"]))
    rows = [r for r in rows if any(c.isalpha() for c in r["t"])]
    return KernelModel([r["t"] for r in rows], [r["l"] for r in rows], landmarks, ridge)


def predict(docs: DataFrame, model: KernelModel, text_col: str = "text") -> DataFrame:
    """The rows with lang_pred and score.

    Null texts and texts without a letter get `und` and 0, as does everything if no language was
    learned; repeated rows are scored alike; ties go to the language first in order. Columns of the
    result's names that the frame has already are replaced.
    """
    docs = without(docs, ("lang_pred", "score"), text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(text_col))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores)],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return docs.mapInArrow(run, schema_with(docs, RESULT))


LEAST_SCORE = 0.2


def keep_known_languages(
    docs: DataFrame, model: KernelModel, text_col: str = "text", least_score: float = LEAST_SCORE
) -> DataFrame:
    """Documents with a known language, all columns unchanged.

    Rejected are texts without a letter, and those that are clearly none of the languages: their
    best one-versus-rest answer lies well on the side of the rest (score under `least_score`).
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = predict(plain, model, f"c{names.index(text_col)}")
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
