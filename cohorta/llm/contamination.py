"""Benchmark decontamination: an FM-index over each block of training text, searched backwards.

Every Arrow block of documents is one shard. Its words become symbols: the benchmark's words
get numbers, every other word ends a run. Runs shorter than the shortest test phrase can hold no
phrase and are left out, which loses nothing. Over the rest the shard builds a suffix array, the
Burrows-Wheeler transform and a wavelet matrix; all phrases are searched backwards at once by rank
queries, occurrences are located by walking to sampled suffix positions, and overlapping
occurrences merge into removal spans. No row leaves its shard, so nothing is shuffled and a hot
source or a passage in a third of the documents changes nothing.

The benchmark is taken in blocks of bounded size (`block_words`); each block is sent to the tasks
and one pass answers it. Passes are merged per document row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch, schema_with, text_bytes, without
from cohorta.llm.words import FOLD, find_words

WINDOW = 13
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SAMPLE = 8  # every so many text positions keep their suffix row
RESULT_NAMES = ("n_words", "n_hit", "item_ids", "spans")
RESULT = "n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:int,end:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_FOLD))


# ---------------------------------------------------------------- index


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the last symbol must be the only smallest."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, step = len(rank), 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """Rank queries for many symbols at once."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        self.ones_at: list[int] = []
        current = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (current >> level) & 1
            before = np.zeros(len(current) + 1, np.int32)
            np.cumsum(bit == 0, out=before[1:])
            self.zeros.append(before)
            self.ones_at.append(int(before[-1]))
            current = np.concatenate((current[bit == 0], current[bit == 1]))

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        first, last = np.zeros(len(symbols), np.int64), upto.astype(np.int64)
        for k, level in enumerate(range(self.depth - 1, -1, -1)):
            one = ((symbols >> level) & 1).astype(bool)
            zeros, ones_at = self.zeros[k], self.ones_at[k]
            z_first, z_last = zeros[first], zeros[last]
            first = np.where(one, ones_at + first - z_first, z_first)
            last = np.where(one, ones_at + last - z_last, z_last)
        return last - first


class FMIndex:
    """Backward search and location over one sequence of symbols from 1 up."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        text = np.concatenate((symbols, [0]))
        order = suffix_array(text)
        self.size = len(text)
        self.bwt = text[order - 1]
        self.tree = WaveletMatrix(self.bwt, alphabet + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet + 1))))
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of each phrase; all phrases of one length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
            dead = live[low[live] >= high[live]]
            high[dead] = low[dead]
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        rows, found = rows.copy(), np.empty(len(rows), np.int64)
        live, steps = np.arange(len(rows)), 0
        while len(live):
            at = rows[live]
            done = self.sampled[at]
            found[live[done]] = self.samples[self.sample_rank[at[done]]] + steps
            live, at = live[~done], at[~done]
            symbol = self.bwt[at]
            rows[live] = self.before[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return found


# ---------------------------------------------------------------- phrases


@dataclass
class Phrases:
    """Test phrases of a block of items over numbered words."""

    vocabulary: list[str]
    hashes: np.ndarray  # sorted
    symbols: np.ndarray  # of each hash
    by_length: dict[int, np.ndarray]  # distinct phrases
    owners: dict[int, list[list[str]]]  # item ids of each phrase

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=0)


def phrases_of(items: Iterable[tuple[str, list[str]]], window: int) -> Phrases:
    numbers: dict[str, int] = {}
    found: dict[int, dict[tuple, set]] = {}
    for item, words in items:
        ids = tuple(numbers.setdefault(w, len(numbers) + 1) for w in words)
        length = min(window, len(ids))
        for i in range(len(ids) - length + 1):
            found.setdefault(length, {}).setdefault(ids[i : i + length], set()).add(item)
    encoded = [w.encode() for w in numbers]
    blob = np.frombuffer(b"".join(encoded), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in encoded]))).astype(np.int64)
    hashes = find_words(blob, offsets).hashes
    order = np.argsort(hashes)
    return Phrases(
        list(numbers),
        hashes[order],
        (order + 1).astype(np.int64),
        {n: np.array(sorted(group), np.int64) for n, group in found.items()},
        {n: [sorted(group[p]) for p in sorted(group)] for n, group in found.items()},
    )


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """Items with words, in blocks of a bounded number of words; rows without an id are ignored."""
    block, size = [], 0
    rows = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("string"), F.col(text_col))
    for item, text in rows.toLocalIterator():
        words = words_of(text)
        if words:
            block.append((item, words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


# ---------------------------------------------------------------- shards


def _symbols(blob: np.ndarray, words, phrases: Phrases) -> np.ndarray:
    """Number of each word, 0 for words the benchmark doesn't have."""
    if not len(words.hashes):
        return np.zeros(0, np.int64)
    table = np.zeros(1 << 16, bool)
    table[(phrases.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(words.hashes & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.searchsorted(phrases.hashes, words.hashes[maybe])
    at[at == len(phrases.hashes)] = 0
    equal = phrases.hashes[at] == words.hashes[maybe]
    numbers = np.zeros(len(words.hashes), np.int64)
    numbers[maybe[equal]] = phrases.symbols[at[equal]]
    return numbers


def _long_runs(numbers: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Indexes of the words in runs of benchmark words that are long enough, text by text."""
    if not len(numbers):
        return np.zeros(0, np.int64)
    broken = np.ones(len(numbers), bool)
    broken[1:] = (numbers[1:] == 0) | (numbers[:-1] == 0)
    broken[bounds[:-1][bounds[:-1] < len(numbers)]] = True
    run = np.cumsum(broken) - 1
    sizes = np.bincount(run, weights=numbers > 0)
    return np.flatnonzero((sizes[run] >= least) & (numbers > 0))


def _chars_before(blob: np.ndarray) -> np.ndarray:
    """Code points before each byte of one text, and at its end."""
    return np.concatenate(([0], np.cumsum((blob & 0xC0) != 0x80)))


def search_shard(column: pa.Array, phrases: Phrases, earlier: tuple[list, list] | None = None):
    """Per text: words, hit words, item ids and removal spans in code points.

    earlier: item ids and spans of the texts from other benchmark blocks, to be merged in.
    """
    blob, offsets = text_bytes(column)
    words = find_words(blob, offsets)
    counts = words.counts()
    n = len(counts)
    hits = np.zeros(len(words.hashes), bool)
    items: list[set] = [set(x) for x in earlier[0]] if earlier else [set() for _ in range(n)]
    for i, before in enumerate(earlier[1] if earlier else ()):
        if before:
            own = slice(words.bounds[i], words.bounds[i + 1])
            chars = _chars_before(blob[offsets[i] : offsets[i + 1]])[words.starts[own] - offsets[i]]
            for span in before:
                hits[own] |= (chars >= span["start"]) & (chars < span["end"])
    numbers = _symbols(blob, words, phrases)
    chosen = _long_runs(numbers, words.bounds, phrases.shortest)
    # equal hashes are not proof of equal words
    raw = FOLD[blob].tobytes() if len(chosen) else b""
    same = [
        raw[words.starts[i] : words.ends[i]].decode() == phrases.vocabulary[numbers[i] - 1] for i in chosen.tolist()
    ]
    if not all(same):
        numbers[chosen[~np.array(same)]] = 0
        chosen = _long_runs(numbers, words.bounds, phrases.shortest)
    if len(chosen):
        owner = np.searchsorted(words.bounds, chosen, side="right") - 1
        gap = np.ones(len(chosen), bool)
        gap[1:] = (np.diff(chosen) != 1) | (np.diff(owner) != 0)
        place = np.arange(len(chosen)) + np.cumsum(gap) - 1  # one separator before each later run
        alphabet = len(phrases.vocabulary) + 1
        text = np.full(place[-1] + 1, alphabet, np.int64)
        text[place] = numbers[chosen]
        word_at = np.full(len(text), -1, np.int64)
        word_at[place] = chosen
        index = FMIndex(text, alphabet)
        for length, table in phrases.by_length.items():
            low, high = index.search(table)
            found = np.flatnonzero(high > low)
            if not len(found):
                continue
            times = (high - low)[found]
            rows = np.repeat(low[found] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            first = word_at[index.locate(rows)]
            edge = np.zeros(len(hits) + 1, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + length, -1)
            hits |= np.cumsum(edge[:-1]) > 0
            texts = np.searchsorted(words.bounds, first, side="right") - 1
            pairs = np.unique(np.stack((texts, np.repeat(found, times))), axis=1)
            for text_no, phrase in pairs.T.tolist():
                items[text_no].update(phrases.owners[length][phrase])
    n_hit = np.add.reduceat(np.concatenate((hits, [0])).astype(np.int64), words.bounds[:-1]) if n else np.zeros(0)
    n_hit = np.where(counts > 0, n_hit, 0)
    spans: list[list[dict]] = [[] for _ in range(n)]
    for i in np.flatnonzero(n_hit).tolist():
        low, high = words.bounds[i], words.bounds[i + 1]
        own = np.concatenate(([False], hits[low:high], [False])).astype(np.int8)
        heads, tails = np.flatnonzero(np.diff(own) == 1), np.flatnonzero(np.diff(own) == -1)
        chars = _chars_before(blob[offsets[i] : offsets[i + 1]])
        start = chars[words.starts[low + heads] - offsets[i]]
        end = chars[words.ends[low + tails - 1] - offsets[i]]
        spans[i] = [{"start": int(s), "end": int(e)} for s, e in zip(start, end, strict=True)]
    return counts, n_hit, [sorted(s) for s in items], spans


def _with_result(batch: pa.RecordBatch, text_col: str, phrases: Phrases, further: bool) -> pa.RecordBatch:
    earlier = None
    if further:
        earlier = (batch.column("item_ids").to_pylist(), batch.column("spans").to_pylist())
        batch = batch.select([n for n in batch.schema.names if n not in RESULT_NAMES])
    counts, n_hit, items, spans = search_shard(batch.column(text_col), phrases, earlier)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    more = {
        "n_words": pa.array(counts, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "item_ids": pa.array(items, pa.list_(pa.string())),
        "spans": pa.array(spans, span),
    }
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = 1_000_000,
) -> DataFrame:
    """The documents' rows with n_words, n_hit, item_ids and spans (code points, end exclusive).

    A phrase is every run of `window` words of an item, or the whole item if it has fewer. A word
    inside any occurrence of a phrase is hit; hit words side by side form one span. Null and empty
    texts have no words; items without words or without an id are ignored; repeated rows are each
    judged on their own; an empty benchmark hits nothing. A benchmark of more than `block_words`
    words takes one pass for each such block, written to the shared folder in between. Columns of
    these four names that the frame has already are replaced.
    """
    docs = without(docs, RESULT_NAMES, text_col)
    scratch = Scratch(docs.sparkSession, "contamination")
    result, passes = None, 0
    for block in item_blocks(benchmark.select(item_col, item_text_col), item_col, item_text_col, block_words):
        if passes:
            result = scratch.keep(result, f"pass{passes}")
        result = _search_block(docs if result is None else result, block, text_col, window, passes > 0)
        passes += 1
    return _search_block(docs, [], text_col, window, False) if result is None else result


def _search_block(docs: DataFrame, block: list, text_col: str, window: int, further: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(phrases_of(block, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _with_result(batch, text_col, shared.value, further)

    return docs.mapInArrow(run, docs.schema if further else schema_with(docs, RESULT))


def contaminated(n_hit, n_words):
    """Whether at least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that are not contaminated, with all their columns and unchanged texts."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = find_contamination(plain, benchmark, f"c{names.index(text_col)}")
    kept = found.where(~contaminated(F.col("n_hit"), F.col("n_words")))
    return kept.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
