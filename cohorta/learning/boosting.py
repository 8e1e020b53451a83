"""Leaf-wise gradient boosting over binned features, with log loss.

Rows are binned once and written as blocks of small integers. A tree grows best first: the leaf whose
split gains most is split next, until there are as many leaves as allowed. What is needed for that are
histograms of gradients and hessians; one job gives those of all leaves that can be next, so a tree
takes a job a level or so. Only the smaller child of a split is summed, the other is its parent less it.
The driver holds histograms of one tree: leaves x features x bins numbers. Raw scores are carried in the
blocks, which are written anew every few trees; the trees since then are added up as blocks are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cohorta.learning.classifiers import BinaryEstimator, MarginModel
from cohorta.session import materialize

BLOCK_ROWS = 65_536
CHUNK = 8  # features whose histograms travel together
WRITE_EVERY = 4  # trees; each tree that is not written is gone through again by every job
LEAST_HESSIAN = 1e-3  # of a child
LEAST_GAIN = 1e-12  # of a split: less is rounding
BLOCKS = "n int, bins binary, y binary, raw binary"


def bin_cuts(rows: DataFrame, width: int, most: int) -> list[list[float]]:
    """Cuts of each feature of (x): x falls in bin b if it is above b cuts.

    A feature of at most ``most`` values has a cut halfway between neighbours, another one at quantiles, from a
    sketch whose ranks are right to a quarter of a bin.
    """

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0) for _ in range(width)]
        for batch in batches:
            x = np.asarray(batch.column(0).flatten()).reshape(-1, width)
            for i in range(width):
                if len(seen[i]) <= most:
                    seen[i] = np.union1d(seen[i], x[:, i])[: most + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(width, dtype=np.int32), [len(s) for s in seen])), pa.array(np.concatenate(seen))], ["i", "v"]
        )

    distinct = rows.select("x").mapInArrow(values, "i int, v double").distinct()
    levels = materialize(distinct, "bin-values")
    few = {r["i"] for r in levels.groupBy("i").count().where(F.col("count") <= most).collect()}
    cuts: list[list[float]] = [[] for _ in range(width)]
    found: dict[int, list[float]] = {i: [] for i in few}
    for r in levels.where(F.col("i").isin(sorted(few))).toLocalIterator():  # at most `most` a feature
        found[r["i"]].append(r["v"])
    for i, known in found.items():
        known.sort()
        cuts[i] = [(a + b) / 2 for a, b in zip(known, known[1:])]
    many = [i for i in range(width) if i not in few]
    if many:
        wide = rows.select(*[F.col("x")[i].alias(f"c{i}") for i in many])
        wanted = [k / most for k in range(1, most)]
        for i, got in zip(many, wide.approxQuantile([f"c{i}" for i in many], wanted, 0.25 / most)):
            cuts[i] = sorted(set(got))
    return cuts


def pack(rows: DataFrame, cuts: list[list[float]], start: float) -> DataFrame:
    """Blocks of (x, y) rows: bins, labels and the raw scores they start from."""
    width = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = [np.array(c) for c in cuts]
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                x = np.asarray(part.column(0).flatten()).reshape(-1, width)
                bins = np.stack([np.searchsorted(borders[i], x[:, i]) for i in range(width)], axis=1).astype(np.uint16)
                y = np.asarray(part.column(1)).astype(np.int8)
                yield _block(bins, y, np.full(len(y), start))

    return rows.select("x", "y").mapInArrow(run, BLOCKS)


def _block(bins: np.ndarray, y: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
    cells = pa.array([len(y)], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in (bins, y, raw))
    return pa.RecordBatch.from_arrays(list(cells), ["n", "bins", "y", "raw"])


def _unpack(blocks: Iterator[Row], trees: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, labels, raw scores with the given trees) of each block."""
    for n, bins, y, raw in blocks:
        bins = np.frombuffer(bins, np.uint16).reshape(n, -1)
        raw = np.frombuffer(raw).copy()
        for tree in trees:
            raw += np.array(tree["value"])[route(tree, bins)]
        yield bins, np.frombuffer(y, np.int8), raw


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The blocks of Arrow batches, one after the other."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in range(4))


def route(tree: dict, x: np.ndarray, by: str = "bin") -> np.ndarray:
    """Node each row ends in; by bins, or by the features' own values and `by` = cut."""
    feature, border, left, right = (np.array(tree[k]) for k in ("feature", by, "left", "right"))
    at = np.zeros(len(x), np.int64)
    going = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(going):
        node = at[going]
        node = np.where(x[going, feature[node]] <= border[node], left[node], right[node])
        at[going] = node
        going = going[feature[node] >= 0]
    return at


class Histograms:
    """Sums of gradients, hessians and rows by (feature, bin) of one node."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells  # 3 x features x bins
        self.g, self.h, self.n = (float(v) for v in cells[:, 0].sum(axis=1))

    def best_split(self, sizes: np.ndarray, least_rows: int, penalty: float) -> tuple[float, int, int, int] | None:
        """(gain, feature, bin, rows on the left) of the best split, the first one of equals; none if nothing is gained."""
        g, h, n = np.cumsum(self.cells, axis=2)[:, :, :-1]
        allowed = np.arange(g.shape[1])[None] < (sizes - 1)[:, None]
        allowed &= (n >= least_rows) & (self.n - n >= least_rows) & (h >= LEAST_HESSIAN) & (self.h - h >= LEAST_HESSIAN)
        if not allowed.any():
            return None
        loss = lambda g, h: g * g / (h + penalty + 1e-15)
        gain = np.where(allowed, loss(g, h) + loss(self.g - g, self.h - h) - loss(self.g, self.h), -np.inf)
        best = gain.max()
        if not best > LEAST_GAIN:
            return None
        feature, at = divmod(int(np.flatnonzero(gain.ravel() >= best - 1e-10 * abs(best))[0]), gain.shape[1])
        return float(gain[feature, at]), feature, at, int(round(float(n[feature, at])))


def node_histograms(blocks: DataFrame, trees: list[dict], tree: dict, nodes: list[int], sizes: np.ndarray) -> dict[int, Histograms]:
    """Histograms of the given nodes of a growing tree, from one job."""
    width, bins = len(sizes), int(sizes.max())

    def sums(blocks: Iterator[Row]) -> Iterator[tuple[tuple[int, int], bytes]]:
        place = np.full(len(tree["feature"]), -1)
        place[nodes] = np.arange(len(nodes))
        cells = np.zeros((len(nodes), 3, width * bins))
        for x, y, raw in _unpack(blocks, trees):
            at = place[route(tree, x)]
            rows = np.flatnonzero(at >= 0)
            p = 1 / (1 + np.exp(-raw[rows]))
            flat = (np.arange(width) * bins + x[rows]) + at[rows, None] * (width * bins)
            for k, v in enumerate((p - y[rows], p * (1 - p), None)):
                weights = None if v is None else np.repeat(v, width)
                cells[:, k] += np.bincount(flat.ravel(), weights, len(nodes) * width * bins).reshape(len(nodes), -1)
        cells = cells.reshape(len(nodes), 3, width, bins)
        for j, node in enumerate(nodes):
            for low in range(0, width, CHUNK):
                part = np.ascontiguousarray(cells[j, :, low : low + CHUNK])
                if part[2].any():
                    yield (node, low), part.tobytes()

    def add(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    # plain jobs: a tree takes about ten, and planning a query for each took longer than the sums
    parts = blocks.rdd.mapPartitions(sums)
    tasks = min(parts.getNumPartitions(), len(nodes) * -(-width // CHUNK))
    found = {node: np.zeros((3, width, bins)) for node in nodes}
    for (node, low), summed in parts.reduceByKey(add, tasks).collect():
        part = np.frombuffer(summed).reshape(3, -1, bins)
        found[node][:, low : low + part.shape[1]] = part
    return {node: Histograms(cells) for node, cells in found.items()}


class Growing:
    """One tree while it grows: known nodes, and which of them are split so far."""

    def __init__(self, settings: dict, cuts: list[list[float]]):
        self.settings, self.cuts = settings, cuts
        self.sizes = np.array([len(c) + 1 for c in cuts])
        self.feature, self.bin, self.left, self.right, self.depth = [-1], [0], [-1], [-1], [0]
        self.held: list[Histograms | None] = [None]
        self.split: list[tuple | None] = [None]

    def learn(self, node: int, held: Histograms) -> None:
        s = self.settings
        self.held[node] = held
        deepest = s["max_depth"] is not None and self.depth[node] >= s["max_depth"]
        self.split[node] = None if deepest else held.best_split(self.sizes, s["min_samples_leaf"], s["l2_regularization"])

    def first_splits(self) -> tuple[list[int], list[int]]:
        """Nodes that best-first growth splits, and those of them whose children are not known yet.

        While children are unknown, the growth goes on without them, so the nodes in question may be more than are split in the end.
        """
        done, open_ = [], []
        heap = [(-self.split[0][0], 0)] if self.split[0] else []
        while heap and len(done) + 1 < self.settings["max_leaf_nodes"]:
            _, node = heapq.heappop(heap)
            done.append(node)
            if self.left[node] < 0:
                open_.append(node)
                continue
            for child in (self.left[node], self.right[node]):
                if self.split[child]:
                    heapq.heappush(heap, (-self.split[child][0], child))
        return done, open_

    def grow(self, blocks: DataFrame, trees: list[dict]) -> dict:
        self.learn(0, node_histograms(blocks, trees, self.table(), [0], self.sizes)[0])
        while True:
            done, open_ = self.first_splits()
            if not open_:
                return self.finished(done)
            wanted = {}
            for node in open_:
                gain, feature, at, n_left = self.split[node]
                self.feature[node], self.bin[node] = feature, at
                for side in (self.left, self.right):
                    side[node] = len(self.feature)
                    for column, value in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.depth, self.depth[node] + 1), (self.held, None), (self.split, None)):
                        column.append(value)
                smaller = self.left[node] if 2 * n_left <= self.held[node].n else self.right[node]
                wanted[smaller] = node
            for child, held in node_histograms(blocks, trees, self.table(), sorted(wanted), self.sizes).items():
                node = wanted[child]
                other = self.left[node] + self.right[node] - child
                self.learn(child, held)
                self.learn(other, Histograms(self.held[node].cells - held.cells))

    def table(self) -> dict:
        return {"feature": list(self.feature), "bin": list(self.bin), "left": list(self.left), "right": list(self.right)}

    def finished(self, done: list[int]) -> dict:
        """The tree of the nodes that are split, numbered anew, with leaf values."""
        s, split = self.settings, set(done)
        tree: dict[str, list] = {k: [] for k in ("feature", "bin", "cut", "left", "right", "value", "gain", "rows")}
        number, order = {0: 0}, [0]
        for node in order:
            held = self.held[node]
            inner = node in split
            if inner:
                for child in (self.left[node], self.right[node]):
                    number[child] = len(order)
                    order.append(child)
            f, b = (self.feature[node], self.bin[node]) if inner else (-1, 0)
            row = {
                "feature": f, "bin": b, "cut": float(self.cuts[f][b]) if inner else 0.0,
                "left": number[self.left[node]] if inner else -1, "right": number[self.right[node]] if inner else -1,
                "value": -s["learning_rate"] * held.g / (held.h + s["l2_regularization"] + 1e-15),
                "gain": self.split[node][0] if inner else 0.0, "rows": int(round(held.n)),
            }
            for name, value in row.items():
                tree[name].append(value)
        return tree


class HistogramBoostingModel(MarginModel):
    """Log-odds: a constant and one leaf value a tree."""

    def margin(self, x: Column) -> Column:
        state = self.fitted()
        start, trees = state["start"], state["trees"]

        @F.pandas_udf("double")
        def total(values: pd.Series) -> pd.Series:
            rows = np.stack(values.to_list()) if len(values) else np.zeros((0, 1))
            out = np.full(len(rows), start)
            for tree in trees:
                out += np.array(tree["value"])[route(tree, rows, "cut")]
            return pd.Series(out)

        return total(x)


class HistogramBoosting(BinaryEstimator):
    """Gradient boosting with the defaults of its settings below; there is no early stopping.

    Settings: max_iter, learning_rate, max_leaf_nodes, max_depth, min_samples_leaf, l2_regularization, max_bins.
    """

    def _fit(self, dataset: DataFrame) -> HistogramBoostingModel:
        # Defaults.
        settings = {
            name: self.setting(name, default)
            for name, default in (
                ("max_iter", 100), ("learning_rate", 0.1), ("max_leaf_nodes", 31), ("max_depth", None),
                ("min_samples_leaf", 20), ("l2_regularization", 0.0), ("max_bins", 255), ("write_every", WRITE_EVERY),
            )
        }
        label = F.col(self.getLabelCol()).cast("int")
        rows = materialize(dataset.select(vector_to_array("features").alias("x"), label.alias("y")), "boosting-rows")
        counts = rows.agg(F.count("*").alias("n"), F.sum("y").alias("p"), F.max(F.size("x")).alias("width")).first()
        if not counts["n"] or counts["p"] in (0, counts["n"]):
            raise ValueError("Training rows must hold both classes.")
        start = math.log(counts["p"] / (counts["n"] - counts["p"]))
        cuts = bin_cuts(rows, counts["width"], settings["max_bins"])
        # as many partitions as rows fill: every job of the fit reads them all
        even = rows.repartition(1 + counts["n"] // BLOCK_ROWS)
        blocks = materialize(pack(even, cuts, start), "boosting-blocks")
        trees: list[dict] = []
        pending: list[dict] = []
        for number in range(1, settings["max_iter"] + 1):
            tree = Growing(settings, cuts).grow(blocks, pending)
            trees.append(tree)
            pending.append(tree)
            if number % settings["write_every"] == 0 and number < settings["max_iter"]:
                blocks = materialize(_with_trees(blocks, pending), "boosting-blocks")
                pending = []
        return HistogramBoostingModel({"start": start, "trees": trees})


def _with_trees(blocks: DataFrame, trees: list[dict]) -> DataFrame:
    """The blocks with the trees added to their raw scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y, raw in _unpack(_cells(batches), trees):
            yield _block(bins, y, raw)

    return blocks.mapInArrow(run, BLOCKS)
