"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

The patterns find assignments, access keys and hexadecimal runs. A second look takes every run of
key characters of at least `LEAST` characters that no pattern found and compares two Markov models
of order one: how likely the run is as a random string, and as an ordinary identifier. Both are
trained from labelled samples: the transition counts of all values the patterns found, and of all
other runs in the corpus, are summed over the whole table by Spark; only these few thousand
counts come to the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import schema_with, without

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy from the start of a run, so a run of 24 is one match
LEAST = 16  # characters of a run worth a look
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: log of the odds against a secret before the run is read, and of the certainty asked for
PRIOR, CERTAIN = float(np.log(1e-3)), float(np.log(100.0))
SMOOTH = 5.0  # samples' worth of the letters' own shares
_CODE = np.full(256, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
SIZE = len(ALPHABET)
RESULT_NAMES = ("n_assign", "n_access", "n_hex", "base_spans", "spans")
RESULT = "n_assign bigint, n_access bigint, n_hex bigint, base_spans array<string>, spans array<string>"


def base_matches(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, kind number, kind, end, value start) by start, then kind; leftmost per kind."""
    found = [(m.start(), 0, "assign", m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, "hex", m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def runs(text: str, found: list) -> Iterator[tuple[int, int]]:
    """Runs of key characters that touch no pattern's match."""
    starts = [f[0] for f in found]
    reach = list(accumulate((f[3] for f in found), max))
    for m in RUN.finditer(text):
        before = bisect_left(starts, m.end())
        if not before or reach[before - 1] <= m.start():
            yield m.span()


def transitions(strings: Iterable[str]) -> np.ndarray:
    """Counts of (character, next character); row SIZE holds the first characters."""
    counts = np.zeros((SIZE + 1, SIZE), np.int64)
    joined = "\n".join(strings).encode("ascii", "replace")
    if not joined:
        return counts
    codes = _CODE[np.frombuffer(joined, np.uint8)]
    before = np.concatenate(([SIZE], np.where(codes[:-1] < 0, SIZE, codes[:-1])))
    real = codes >= 0
    np.add.at(counts, (before[real], codes[real]), 1)
    return counts


class Model:
    """Log-likelihood ratio of each transition: random string against identifier."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray):
        self.ratio = self._log(random) - self._log(ordinary)

    @staticmethod
    def _log(counts: np.ndarray) -> np.ndarray:
        # what follows a rare letter is smoothed towards all letters, and these towards equal shares
        letters = counts.sum(axis=0) + 0.5
        smooth = counts + SMOOTH * letters / letters.sum()
        return np.log(smooth / smooth.sum(axis=1, keepdims=True))

    def score(self, run: str) -> float:
        codes = _CODE[np.frombuffer(run.encode("ascii"), np.uint8)]
        return float(self.ratio[np.concatenate(([SIZE], codes[:-1])), codes].sum())

    def is_secret(self, run: str) -> bool:
        return self.score(run) + PRIOR > CERTAIN


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Models from the whole table: what the patterns found against all other runs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, ordinary = np.zeros((SIZE + 1, SIZE), np.int64), np.zeros((SIZE + 1, SIZE), np.int64)
        for batch in batches:
            secret, plain = [], []
            for value in batch.column(0):
                text = value.as_py() or ""
                found = base_matches(text)
                secret += [part for _, _, _, end, at in found for part in RUN.findall(text[at:end])]
                plain += [text[a:b] for a, b in runs(text, found)]
            random += transitions(secret)
            ordinary += transitions(plain)
        flat = np.concatenate((random.ravel(), ordinary.ravel()))
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["cell", "n"])

    cells = docs.select(F.col(text_col)).mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(2 * (SIZE + 1) * SIZE, np.int64)
    for row in cells.collect():  # at most one row for each of the fixed cells
        flat[row["cell"]] = row["n"]
    random, ordinary = flat.reshape(2, SIZE + 1, SIZE)
    return Model(random, ordinary)


def scan_text(text: str | None, model: Model) -> tuple[list, list[str], list[str]]:
    text = text or ""
    found = base_matches(text)
    base = [f"{kind}:{start}:{end}" for start, _, kind, end, _ in found]
    more = [(a, 3, "markov", b, a) for a, b in runs(text, found) if model.is_secret(text[a:b])]
    spans = base if not more else [f"{k}:{s}:{e}" for s, _, k, e, _ in sorted(found + more)]
    kinds = [f[1] for f in found]
    return [kinds.count(k) for k in range(3)], base, spans


def find_secrets(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with counts and spans (`kind:start:end`, code points, end exclusive).

    Null and empty texts have no spans; repeated rows are each scanned. Columns of the result's names
    that the frame has already are replaced.
    """
    docs = without(docs, RESULT_NAMES, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, spans = [], [], []
            for value in batch.column(text_col):
                n, b, s = scan_text(value.as_py(), shared.value)
                counts.append(n)
                base.append(b)
                spans.append(s)
            table = np.array(counts, np.int64).reshape(-1, 3)
            more = {
                "n_assign": pa.array(table[:, 0]),
                "n_access": pa.array(table[:, 1]),
                "n_hex": pa.array(table[:, 2]),
                "base_spans": pa.array(base, pa.list_(pa.string())),
                "spans": pa.array(spans, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])

    return docs.mapInArrow(run, schema_with(docs, RESULT))
