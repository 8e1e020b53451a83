"""Ranked lexical search by bag deduplication.

Of a document only its bag counts: which of the items' terms it holds, how often, and its length factor m. A first pass
over the texts reduces every document to its bag. Documents with equal bags, found by hash and compared in full,
form a class: they have one score with every item, so only a class's first `top` documents can be among an
item's results, and one of them is scored. A task scores its classes against the items by products of two matrices,
the terms' shares in each class and the terms' numbers in each item, and keeps an item's `top` documents.

Items are taken in blocks of bounded vocabulary; a benchmark of one block takes one pass over the texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorta.llm.common import Scratch, ready

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # after A-Z became a-z
EDGE = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
PIECE = 1 << 20  # bytes of a text cut into terms at a time
VOCABULARY = 200_000  # distinct terms a block of items may have, unless one item alone has more
ITEMS = 4096  # items of a block
COLUMNS, ROWS = 256, 512  # items and classes of one matrix product
CELLS = 1 << 22  # of one matrix
BAG = "id bigint, null_id boolean, n bigint, terms binary, counts binary"
FOUND = "item int, id bigint, null_id boolean, score bigint"
# Fixed values of the score: m is BASE and SLOPE times the length over the mean; a term's share is SCALE tf over TF tf + LENGTH m.
BASE, SLOPE, SCALE, TF, LENGTH = 100 - 25, 25, 1_000_000_000, 1000, 12


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, a piece at a time; no term is cut."""
    data = (text or "").encode().lower()  # of bytes only A-Z are lower-cased
    at = 0
    while at < len(data):
        stop = len(data)
        if stop - at > PIECE:
            edge = EDGE.search(data, at + PIECE)
            stop = edge.start() if edge else stop
        yield TERM.findall(data[at:stop])
        at = stop


@dataclass
class Items:
    """Items of one block: how often each holds each term of the block's vocabulary."""

    number: dict[bytes, int]
    bags: list[tuple[np.ndarray, np.ndarray]]

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first item, terms, matrix terms x items) for some items at a time, as many as fit `CELLS`."""
        at = 0
        while at < len(self.bags):
            used, stop = np.zeros(0, np.int32), at
            while stop < len(self.bags) and stop - at < COLUMNS:
                more = np.union1d(used, self.bags[stop][0])
                if stop > at and len(more) * (stop + 1 - at) > CELLS:
                    break
                used, stop = more, stop + 1
            matrix = np.zeros((len(used), stop - at), np.int64)
            for j in range(at, stop):
                found, counts = self.bags[j]
                matrix[np.searchsorted(used, found), j - at] = counts
            yield at, used, matrix
            at = stop


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[Items, list]]:
    """Blocks of items with at least one term, and their ids; rows come to the driver one at a time."""
    number: dict[bytes, int] = {}
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    ids: list = []
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        held: dict[bytes, int] = {}
        for piece in terms(row["t"]):
            for term in piece:
                held[term] = held.get(term, 0) + 1
        if not held:
            continue
        if bags and (len(bags) == ITEMS or len(number) + sum(t not in number for t in held) > VOCABULARY):
            yield Items(number, bags), ids
            number, bags, ids = {}, [], []
        found = np.array([number.setdefault(t, len(number)) for t in held], np.int32)
        order = np.argsort(found)
        bags.append((found[order], np.array(list(held.values()), np.int64)[order]))
        ids.append(row["i"])
    if bags:
        yield Items(number, bags), ids


def bags(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Every document with a term: its number of terms, and its terms of the vocabulary with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get
        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0), batch.column(1), strict=True):
                n, held = 0, []
                for piece in terms(text.as_py()):
                    n += len(piece)
                    held.append(np.array([t for t in map(find, piece) if t is not None], np.int32))
                if n:
                    found, counts = np.unique(np.concatenate(held), return_counts=True)
                    own = row.as_py()
                    out.append((own or 0, own is None, n, found.astype(np.int32).tobytes(), counts.astype(np.int64).tobytes()))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "null_id", "n", "terms", "counts"]
            )

    return docs.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(run, BAG)


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs; the driver gets one number a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            held = b"".join(x.as_py() for x in batch.column(0))
            seen += np.bincount(np.frombuffer(held, np.int32), minlength=size)
        (used,) = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(seen[used], pa.int64())], ["term", "n"])

    counted = found.select("terms").mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(size, np.int64)
    for row in counted.toLocalIterator():
        df[row["term"]] = row["n"]
    return df


class Best:
    """The first `top` (score, id) of every item among the documents seen so far; null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(items)]

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, null_ids: np.ndarray) -> None:
        """scores: documents x items, the items from number `first` on."""
        for j in range(scores.shape[1]):
            column = scores[:, j]
            s, i, z = self.kept[first + j]
            least = s[-1] if len(s) == self.top else 1
            new = np.flatnonzero(column >= least)
            if len(new) > 4 * self.top:  # only what reaches the top-th score can be kept
                cut = -np.partition(-column[new], self.top - 1)[self.top - 1]
                new = new[column[new] >= cut]
            if len(new):
                s, i, z = np.concatenate((s, column[new])), np.concatenate((i, ids[new])), np.concatenate((z, null_ids[new]))
                order = np.lexsort((i, z, -s))[: self.top]
                self.kept[first + j] = s[order], i[order], z[order]


def class_scores(matrix: np.ndarray, used: np.ndarray, weights: np.ndarray, rows: list[tuple]) -> np.ndarray:
    """Scores of classes (m, terms, counts) with the items of one matrix."""
    shares = np.zeros((len(rows), len(used)), np.int64)
    for r, (m, found, counts) in enumerate(rows):
        at = np.searchsorted(used, found)
        at[at == len(used)] = 0
        here = used[at] == found if len(used) else np.zeros(0, bool)
        counts = counts[here]
        shares[r, at[here]] = weights[found[here]] * (SCALE * counts // (TF * counts + LENGTH * m))
    # products of whole numbers in doubles are exact below 2^53, and fast; beyond it, whole numbers
    most = float(shares.max(initial=0)) * float(matrix.sum(axis=0).max(initial=0))
    if most < 2**53:
        return (shares.astype(float) @ matrix.astype(float)).astype(np.int64)
    return shares @ matrix


def scored(classes: DataFrame, items: Items, weights: np.ndarray, top: int) -> DataFrame:
    """The first `top` documents of each item among a task's, from rows (class number, m, bag, document) in class order."""
    shared = classes.sparkSession.sparkContext.broadcast((items.bags, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_weights = shared.value
        parts = list(Items({}, own).parts())
        best = Best(len(own), top)
        pending: list[tuple] = []  # classes not scored yet, and their documents
        members: list[tuple[int, int, bool]] = []
        last = None

        def flush() -> None:
            if pending:
                heads = np.array([m[0] for m in members])
                ids = np.array([m[1] for m in members], np.int64)
                null_ids = np.array([m[2] for m in members], bool)
                for first, used, matrix in parts:
                    step = max(1, min(ROWS, CELLS // max(1, len(used))))
                    found = np.concatenate([class_scores(matrix, used, own_weights, pending[a : a + step]) for a in range(0, len(pending), step)])
                    best.add(first, found[heads], ids, null_ids)
            pending.clear()
            members.clear()

        for batch in batches:
            for row, null, m, held, counts in zip(*(batch.column(c) for c in range(5)), strict=True):
                this = (m.as_py(), held.as_py(), counts.as_py())
                if this != last or not pending:
                    if len(pending) >= ROWS:
                        flush()
                    pending.append((this[0], np.frombuffer(this[1], np.int32), np.frombuffer(this[2], np.int64)))
                    last = this
                members.append((len(pending) - 1, row.as_py(), null.as_py()))
        flush()
        for item, (s, i, z) in enumerate(best.kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), item, np.int32)), pa.array(i), pa.array(z), pa.array(s)], ["item", "id", "null_id", "score"]
            )

    return classes.mapInArrow(run, FOUND)


def _search_block(held: DataFrame, items: Items, ids: list, item_type: T.DataType, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block of items, from the written bags."""
    # N documents with a term, L terms in all of them
    documents, length = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    df = document_counts(held, len(items.number))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    m = F.expr(f"{BASE} + ({SLOPE} * n * {documents}L) div {length}L")
    bag = F.xxhash64("m", "terms", "counts")
    # a class: the hash first, then the bag itself; its first documents are all that can be results
    same = W.partitionBy("h", "m", "terms", "counts").orderBy("null_id", "id")
    classes = (
        held.where(F.length("terms") > 0)
        .select("id", "null_id", m.alias("m"), "terms", "counts")
        .withColumn("h", bag)
        .withColumn("k", F.row_number().over(same))
        .where(F.col("k") <= top)
        .select("id", "null_id", "m", "terms", "counts")
    )
    order = W.partitionBy("item").orderBy(F.desc("score"), "null_id", "id")
    ranked = scored(classes, items, weights, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = held.sparkSession.createDataFrame(list(enumerate(ids)), T.StructType().add("item", T.IntegerType()).add("item_id", item_type))
    return ranked.join(F.broadcast(named), "item").select(  # at most ITEMS names
        "item_id", "rank", F.when(~F.col("null_id"), F.col("id")).alias("doc_id"), "score"
    )


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 20,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0, equal scores by rising id.

    Every row of `benchmark` is an item, with a null id or one that others have, too, and every row of `docs` a document: repeated rows
    are all ranked; a null id comes after the others of its score. Null texts and texts without a term are no documents and find nothing;
    an item whose terms are in no document, or weigh nothing, has no rows. Empty tables give no rows. Other columns play no part.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = Scratch(spark, "search")
    item_type = benchmark.schema[item_col].dataType
    out = None
    for number, (items, ids) in enumerate(item_blocks(benchmark, item_col, item_text_col)):
        held = scratch.keep(bags(docs, items.number, id_col, text_col), f"bags{number}")
        found = scratch.keep(_search_block(held, items, ids, item_type, top), f"found{number}")
        scratch.drop(f"bags{number}")
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = spark.createDataFrame([], "rank int, doc_id bigint, score bigint")
        return empty.select(F.lit(None).cast(item_type).alias("item_id"), "rank", "doc_id", "score")
    return out
