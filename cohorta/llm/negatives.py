"""Hard negatives by the threshold algorithm over blocks of rows.

Rows are packed into blocks; a block holds, for each dimension, its rows in the order of that component.
An anchor walks all these lists at once, from the end its own component points to (the large values
for a positive one, the small for a negative one), a few places a round. A row met in any list for the
first time is scored by random access, as an integer inner product. The values under the walk bound the
score of every row not met yet: their product with the anchor is the threshold. The walk ends when the
threshold falls strictly below the score of each window's k-th row so far, or below all its window lets in.

There are two walks: one over the rows of the anchor's own label for its positives, one over the others
for the windows the positives span. Each gives at most k rows an anchor, window and block, ranked in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch, ready

BLOCK = 4096  # rows of a block
CHUNK = 512  # anchors of a chunk
WAVE = 64  # chunks that visit a block together
STRIDE = 1 << 16  # numbers an anchor's chunk has for its anchors
FIRST_ROUND = 16  # list places of the first round; every round takes twice as many as the one before
LARGEST = 2.0**55  # of an inner product: percentages of it fit 64 bits
PACKED = "block bigint, n int, dims int, ids binary, labels binary, parts binary"


def whole_components(vector: Column) -> Column:
    """floor(256 x) of every component, as doubles of whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double"))


def usable(rows: DataFrame, id_col: str, label: Column, vector_col: str, anchor: Column) -> DataFrame:
    """(id, label, parts, anchor) of the rows that take part.

    Out are rows with a null id, label or vector, and those with a null or non-finite component.
    """
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (
        rows.select(
            F.col(id_col).cast("bigint").alias("id"),
            label.cast("bigint").alias("label"),
            F.col(vector_col).alias("v"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        )
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
        .select("id", "label", whole_components(F.col("v")).alias("parts"), "anchor")
    )


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most `size` rows of one partition; shorter vectors are filled up with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first, made = (context.partitionId() if context else 0) << 22, 0
        ids, labels, vectors = [], [], []

        def block() -> pa.RecordBatch:
            dims = max(map(len, vectors))
            parts = np.zeros((len(vectors), dims))
            for i, v in enumerate(vectors):
                parts[i, : len(v)] = v
            most = float(int(np.sqrt(LARGEST / max(1, dims))))
            parts = np.clip(parts, -most, most).astype(np.int64)
            cells = [first + made], [len(vectors)], [dims], [np.array(ids, np.int64).tobytes()], [np.array(labels, np.int64).tobytes()], [parts.tobytes()]
            kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["block", "n", "dims", "ids", "labels", "parts"]
            )

        for batch in batches:
            offsets = np.asarray(batch.column("parts").offsets)
            values = np.asarray(batch.column("parts").values)
            for i, (row, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                ids.append(row)
                labels.append(label)
                vectors.append(values[offsets[i] : offsets[i + 1]])
                if len(ids) == size:
                    yield block()
                    made += 1
                    ids, labels, vectors = [], [], []
        if ids:
            yield block()

    return rows.mapInArrow(run, PACKED)


def unpack(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = np.frombuffer(row[f"{prefix}parts"], np.int64).reshape(row[f"{prefix}n"], row[f"{prefix}dims"])
    return np.frombuffer(row[f"{prefix}ids"], np.int64), np.frombuffer(row[f"{prefix}labels"], np.int64), parts


class Lists:
    """Rows of one block with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, parts: np.ndarray, dims: int):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.parts = np.zeros((len(ids), dims), np.int64)
        self.parts[:, : parts.shape[1]] = parts[order]
        rising = np.argsort(self.parts, axis=0, kind="stable").T.astype(np.int32)
        self.lists = np.stack((rising, rising[:, ::-1]))  # [0]: small values first, [1]: large ones first
        self.values = np.take_along_axis(self.parts.T[None], self.lists, 2)
        self.largest = int(np.abs(self.parts).max(initial=0))
        # the narrowest numbers that hold every score exactly
        self.kind = np.int64
        self.fast: dict[type, np.ndarray] = {}

    def exact(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and anchor in a number type in which every inner product is exact."""
        bound = float(np.abs(anchor).sum()) * self.largest
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
        if kind not in self.fast:
            self.fast[kind] = self.parts.astype(kind)
        return self.fast[kind], anchor.astype(kind)

    def walk(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, skip: np.ndarray | None = None, own: int | None = None) -> list[list[tuple[int, int]]]:
        """The first k (score, id) of each window low <= score <= high, higher scores and then smaller ids first.

        `skip` marks rows that are no candidates, `own` is an id that is none.
        """
        n = len(self.ids)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(low)
        used = np.flatnonzero(anchor)
        side = (anchor[used] > 0).astype(np.intp)
        rows, point = self.exact(anchor)
        met = np.zeros(n, bool) if skip is None else skip.copy()
        if own is not None:
            met[self.ids == own] = True
        depth, step = 0, FIRST_ROUND
        while depth < n:
            last = min(n, depth + step)
            before = met.copy()
            if len(used):
                met[self.lists[side, used, depth:last].ravel()] = True
                threshold = int((self.values[side, used, last - 1] * anchor[used]).sum())
            else:  # every score is 0
                met[:], threshold, last = True, 0, n
            new = np.flatnonzero(met & ~before)
            if len(new):
                scores = (rows[new] @ point).astype(np.int64)
                for w in range(len(low)):
                    fits = np.flatnonzero((scores >= low[w]) & (scores <= high[w]))
                    if len(fits):
                        found = np.concatenate((best[w][0], scores[fits]))
                        ids = np.concatenate((best[w][1], self.ids[new[fits]]))
                        first = np.lexsort((ids, -found))[:k]
                        best[w] = found[first], ids[first]
            depth, step = last, 2 * step
            if all(
                threshold < low[w] or (len(best[w][0]) == k and threshold < best[w][0][-1]) for w in range(len(low))
            ):
                break
        return [list(zip(s.tolist(), i.tolist(), strict=True)) for s, i in best]


def _visits(blocks: DataFrame, chunks: DataFrame, visit: Callable[[dict, Iterator[dict]], list[tuple]], schema: str) -> DataFrame:
    """What `visit` gives for every block of rows and the stated anchors; the columns of their chunks begin with a_.

    A block and a wave of chunks meet in a group of their own, some MB, by a shuffle: the planner's estimate does
    not know how often chunks are repeated, so nothing of them is left to it to broadcast.
    """
    spark, count = blocks.sparkSession, chunks.count()
    # few chunks meet a block at once, and where there are few blocks, fewer, so that all cores have some
    groups = -(-4 * spark.sparkContext.defaultParallelism // max(1, blocks.count()))
    waves = max(1, -(-count // WAVE), min(count, groups))
    seen = chunks.select([F.col(c).alias(f"a_{c}") for c in chunks.columns])
    seen = seen.withColumn("wave", F.pmod(F.xxhash64("a_block"), F.lit(waves)).cast("int"))
    numbers = blocks.select(F.col("block").alias("met"))  # one a block
    seen = seen.crossJoin(F.broadcast(numbers)).withColumnRenamed("met", "block")
    offered = blocks.withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1))))

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        chunks = (anchors.slice(i, 1).to_pylist()[0] for i in range(anchors.num_rows))
        found = [r for row in rows.to_pylist() for r in visit(row, chunks)]
        return pa.Table.from_batches([_batch(found, schema)])

    return offered.groupBy("block", "wave").cogroup(seen.groupBy("block", "wave")).applyInArrow(run, schema)


ALL = np.iinfo(np.int64)
NEAR = "anchor bigint, anchor_id bigint, score bigint, id bigint"
FAR = "anchor bigint, window int, score bigint, id bigint"


def _anchor(row: dict, place: int) -> int:
    """Number of the anchor at this place of the visiting chunk."""
    return row["a_block"] * STRIDE + place


def _own_label(k: int):
    """Walks among the rows of the anchor's own label."""

    def visit(block: dict, chunks: Iterator[dict]) -> list[tuple]:
        ids, labels, parts = unpack(block)
        lists: dict[tuple[int, int], Lists] = {}
        out = []
        for row in chunks:
            anchor_ids, anchor_labels, anchors = unpack(row, "a_")
            dims = max(parts.shape[1], anchors.shape[1])
            for i, (own, label) in enumerate(zip(anchor_ids.tolist(), anchor_labels.tolist(), strict=True)):
                if (label, dims) not in lists:
                    same = labels == label
                    lists[label, dims] = Lists(ids[same], parts[same], dims)
                point = np.zeros(dims, np.int64)
                point[: anchors.shape[1]] = anchors[i]
                (found,) = lists[label, dims].walk(point, np.array([ALL.min]), np.array([ALL.max]), k, own=own)
                out += [(_anchor(row, i), own, s, r) for s, r in found]
        return out

    return visit


def _windows(k: int):
    """Walks among the rows of other labels, within the windows of the anchor's positives."""

    def visit(block: dict, chunks: Iterator[dict]) -> list[tuple]:
        ids, labels, parts = unpack(block)
        ordered = labels[np.argsort(ids, kind="stable")]
        lists: dict[int, Lists] = {}
        same: dict[int, np.ndarray] = {}
        out = []
        for row in chunks:
            _, anchor_labels, anchors = unpack(row, "a_")
            dims = max(parts.shape[1], anchors.shape[1])
            if dims not in lists:
                lists[dims] = Lists(ids, parts, dims)
            for i, names, low, high in zip(*(row[f"a_{c}"] for c in ("places", "windows", "lows", "highs")), strict=True):
                label = int(anchor_labels[i])
                if label not in same:
                    same[label] = ordered == label
                point = np.zeros(dims, np.int64)
                point[: anchors.shape[1]] = anchors[i]
                found = lists[dims].walk(point, np.array(low), np.array(high), k, skip=same[label])
                out += [(_anchor(row, i), w, s, r) for w, rows in zip(names, found, strict=True) for s, r in rows]
        return out

    return visit


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label: Column | str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """Hard negatives of every (anchor, positive): (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on the rows' own columns. A score is the inner product of floor(256 x) of the components. An anchor's
    positives are its first rows of the same label, negatives the first of other labels whose score is `least` to `most` percent of the
    positive's; higher scores first, then smaller ids. Rows with a null id, label or vector or a null or non-finite component take no
    part. A row of the anchor's own id is not its positive. Repeated rows count as often as they occur, a repeated anchor gives its
    rows that often; among equal ids and scores any is first, the result is the same. Missing components of shorter vectors count 0;
    components so large that percentages of a score would not fit 64 bits are cut. A positive with a negative score has no window;
    no rows, no anchors or one label give no rows. The anchors are stated by the caller and meet all rows in blocks.
    """
    spark = rows.sparkSession
    ready(spark)
    scratch = Scratch(spark, "negatives")
    label = F.col(label) if isinstance(label, str) else label
    part = scratch.keep(usable(rows, id_col, label, vector_col, is_anchor), "rows")
    n, stated = part.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = scratch.keep(pack(part.drop("anchor").repartition(1 + n // block), block), "blocks")
    chunks = scratch.keep(pack(part.where("anchor").drop("anchor").repartition(1 + stated // chunk), chunk), "chunks")
    scratch.drop("rows")

    near = _visits(blocks, chunks, _own_label(positives), NEAR)
    order = W.partitionBy("anchor").orderBy(F.desc("score"), "id")
    chosen = scratch.keep(
        near.withColumn("window", F.row_number().over(order) - 1)
        .where(F.col("window") < positives)
        .select("anchor", "anchor_id", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # least * p <= 100 * s <= most * p, as bounds of the whole number s; a negative p has none
    low, high = F.expr(f"(positive_score * {least} + 99) div 100"), F.expr(f"(positive_score * {most}) div 100")
    bounds = (
        chosen.where("positive_score >= 0")
        .select("anchor", F.struct("window", low.alias("low"), high.alias("high")).alias("w"))
        .groupBy("anchor").agg(F.sort_array(F.collect_list("w")).alias("w"))  # at most `positives` each
        .select(
            F.shiftright("anchor", 16).alias("block"),
            F.struct(F.pmod("anchor", F.lit(STRIDE)).cast("int").alias("place"), F.col("w.window").alias("window"), F.col("w.low").alias("low"), F.col("w.high").alias("high")).alias("a"),
        )
        .groupBy("block").agg(F.sort_array(F.collect_list("a")).alias("a"))  # at most `chunk` each
        .select("block", F.col("a.place").alias("places"), F.col("a.window").alias("windows"), F.col("a.low").alias("lows"), F.col("a.high").alias("highs"))
    )
    bounded = scratch.keep(chunks.hint("merge").join(bounds, "block"), "bounded")
    far = _visits(blocks, bounded, _windows(negatives), FAR)
    order = W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(chosen.hint("merge"), ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
