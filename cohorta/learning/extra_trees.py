"""Extremely randomised trees, grown level by level.

Each node tries a few features with one random cut each, uniform between the node's smallest and largest value,
and takes the one that lowers the Gini impurity most. A level takes two jobs over the rows: the ranges of
the open nodes' features, by which a node's cuts are drawn, then the class counts on both sides of every cut, by
which one is chosen; both are decided where a node's partial sums meet, and for all rows of a block at once.
Draws are hashes of (seed, tree, node), so they depend on nothing else.

As long as the features of all rows fit a task, a task grows a tree by itself, with the same draws, and the driver holds nothing
of it; the rows are dealt to some trees at a time. Where they do not fit, the jobs of a level grow one tree after the other, and the
driver holds that tree. Finished trees are kept in a table of parts of at most NODES nodes. To score, they are sent some trees at a
time, which a worker reads one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohorta.learning.classifiers import BinaryEstimator
from cohorta.learning.stages import _Fitted
from cohorta.session import default_buckets, materialize, new_workspace

BLOCK_ROWS = 65_536  # rows a task looks at together
LEAST_ROWS = 2_000  # of a partition, where there are cores for more
TASK_BYTES = 384 << 20  # of features that a task grows a tree from by itself
DEALT_BYTES = 4 << 30  # of features that are dealt to trees at a time
PACK_ROWS = 8_192  # rows of a block that is dealt
NODES = 250_000  # of a part of a tree in the table
SENT_BYTES = 64 << 20  # of trees that are sent together to score
FOREST = "t int, part int, feature array<int>, cut array<double>, left array<int>, share array<double>"
KINDS = {"feature": np.int32, "cut": np.float64, "left": np.int32, "share": np.float64}
NO_SPLITS = pa.table({"t": np.zeros(0, np.int32), "node": np.zeros(0, np.int64), "feature": np.zeros(0, np.int32), "cut": np.zeros(0)})


def _route(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Node each row ends in; a node's right child follows the left one."""
    feature, cut, left = tree["feature"], tree["cut"], tree["left"]
    at = np.zeros(len(x), np.int64)
    going = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(going):
        node = at[going]
        at[going] = left[node] + (x[going, feature[node]] > cut[node])
        going = going[feature[at[going]] >= 0]
    return at


def tried(seed: int, tree: int, node: int, low: np.ndarray, high: np.ndarray, count: int) -> list[tuple[int, float]]:
    """(feature, cut) pairs a node tries: `count` features that vary in it, each with one cut."""
    rng = np.random.default_rng([seed, tree, node])
    order = rng.permutation(len(low))
    cuts = low + (high - low) * rng.random(len(low))
    chosen = [f for f in order.tolist() if high[f] > low[f]][:count]
    # a cut is below the largest value, so that both sides have rows
    return [(f, float(min(cuts[f], np.nextafter(high[f], low[f])))) for f in chosen]


def gini_gain(left: np.ndarray, whole: np.ndarray) -> float:
    """Fall of n x impurity by a cut, from class counts."""
    impure = lambda c: c.sum() - (c**2).sum() / c.sum() if c.sum() else 0.0
    return float(impure(whole) - impure(left) - impure(whole - left))


def _gini_gains(left: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """`gini_gain` of many cuts at once: (nodes, cuts, 2) counts on the left, (nodes, 2) of the nodes."""

    def impure(c: np.ndarray) -> np.ndarray:
        n = c.sum(axis=-1)
        return n - (c**2).sum(axis=-1) / np.maximum(n, 1)

    return impure(whole)[:, None] - impure(left) - impure(whole[:, None] - left)


def _chosen(whole: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each node is split, and its feature and cut, the first ones of equals."""
    n, under = whole.sum(axis=1)[:, None], left.sum(axis=2)
    gain = np.where((feature >= 0) & (np.minimum(under, n - under) >= least), _gini_gains(left, whole), -np.inf)
    at = np.arange(len(whole)), gain.argmax(axis=1)
    return gain[at] > -np.inf, feature[at].astype(np.int32), cut[at]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels, up to BLOCK_ROWS rows at once."""

    def joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    held, rows = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(low, BLOCK_ROWS)
            if held and rows + part.num_rows > BLOCK_ROWS:
                yield joined(held)
                held, rows = [], 0
            x = np.asarray(part.column(0).flatten()).reshape(-1, width)
            held.append((x, np.asarray(part.column(1)).astype(np.int64)))
            rows += part.num_rows
    if held:
        yield joined(held)


def _lists(values: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel()))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(-1, width)


def _sorted_nodes(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by node, the nodes, and where each starts in that order."""
    node = table["node"].to_numpy()
    order = np.argsort(node, kind="stable")
    nodes, starts = np.unique(node[order], return_index=True)
    return order, nodes, starts


class Forest:
    """The trees while they grow, as arrays; the nodes of the last level are those from `first` on."""

    def __init__(self, count: int, number: int = 0):
        self.number = number  # of the first tree
        self.trees = [{"feature": np.full(1, -1), "cut": np.zeros(1), "left": np.full(1, -1), "share": np.zeros(1)} for _ in range(count)]
        self.first = [0] * count

    def open(self) -> bool:
        return any(len(t["feature"]) > first for t, first in zip(self.trees, self.first))

    def split(self, found: pa.Table) -> None:
        """Split nodes of the last level as (t, node, feature, cut) say; their children are the next level."""
        tree, node = found["t"].to_numpy(), found["node"].to_numpy()
        order = np.lexsort((node, tree))
        feature, cut = found["feature"].to_numpy()[order], found["cut"].to_numpy()[order]
        tree, node = tree[order], node[order]
        ends = np.searchsorted(tree, np.arange(len(self.trees) + 1))
        for t, own in enumerate(self.trees):
            part = slice(ends[t], ends[t + 1])
            made, new = len(own["feature"]), 2 * (ends[t + 1] - ends[t])
            own["feature"][node[part]], own["cut"][node[part]] = feature[part], cut[part]
            own["left"][node[part]] = made + 2 * np.arange(new // 2)
            for name, value in (("feature", -1), ("cut", 0.0), ("left", -1), ("share", 0.0)):
                own[name] = np.concatenate((own[name], np.full(new, value, own[name].dtype)))
            self.first[t] = made


def _open_rows(forest: Forest, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per tree the rows that are in its last level, and their places in that level."""
    for t, (tree, first) in enumerate(zip(forest.trees, forest.first)):
        if len(tree["feature"]) > first:
            at = _route(tree, x) - first
            rows = np.flatnonzero(at >= 0)
            if len(rows):
                yield t, rows, at[rows]


def _by_node(parts: DataFrame, shards: int):
    """Partial sums of the level's nodes in groups that hold whole nodes, none of them many."""
    return parts.groupBy("t", (F.col("node") % shards).alias("shard"))


def level_tries(rows: DataFrame, sent, seed: int, wanted: int, least: int, grows: bool, width: int, shards: int) -> pa.Table:
    """Per node of the last level its class counts and, if it may be split, the features and cuts it tries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for x, y in _blocks(batches, width):
            for t, own, place in _open_rows(forest, x):
                order = np.argsort(place, kind="stable")
                nodes, starts = np.unique(place[order], return_index=True)
                part = x[own[order]]
                ones = np.add.reduceat(y[own[order]], starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(nodes), t, np.int32)), pa.array(nodes + forest.first[t]),
                        pa.array(np.diff(np.append(starts, len(place))) - ones), pa.array(ones),
                        _lists(np.minimum.reduceat(part, starts)), _lists(np.maximum.reduceat(part, starts)),
                    ],
                    ["t", "node", "n0", "n1", "low", "high"],
                )

    def draw(table: pa.Table) -> pa.Table:
        order, nodes, starts = _sorted_nodes(table)
        t, number = table["t"][0].as_py(), sent.value.number
        n0, n1 = (np.add.reduceat(table[c].to_numpy()[order], starts) for c in ("n0", "n1"))
        low = np.minimum.reduceat(_matrix(table["low"], width)[order], starts)
        high = np.maximum.reduceat(_matrix(table["high"], width)[order], starts)
        splits = grows & (n0 > 0) & (n1 > 0) & (n0 + n1 >= 2 * least)
        pairs = [tried(seed, number + t, int(node), low[i], high[i], wanted) if splits[i] else [] for i, node in enumerate(nodes)]
        return pa.table({
            "t": pa.array(np.full(len(nodes), t, np.int32)), "node": pa.array(nodes), "n0": pa.array(n0), "n1": pa.array(n1),
            "feature": pa.array([[f for f, _ in p] for p in pairs], pa.list_(pa.int32())),
            "cut": pa.array([[c for _, c in p] for p in pairs], pa.list_(pa.float64())),
        })

    parts = rows.mapInArrow(run, "t int, node bigint, n0 bigint, n1 bigint, low array<double>, high array<double>")
    schema = "t int, node bigint, n0 bigint, n1 bigint, feature array<int>, cut array<double>"
    return _by_node(parts, shards).applyInArrow(lambda table: draw(table), schema).toArrow()


def _padded(found: pa.Table, forest: Forest, wanted: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per tree and place in the last level: class counts, features (-1: none) and cuts that are tried."""
    tree, node = found["t"].to_numpy(), found["node"].to_numpy()
    order = np.lexsort((node, tree))
    whole = np.column_stack((found["n0"].to_numpy(), found["n1"].to_numpy()))[order]
    lists = found["feature"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    at = np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    feature, cut = np.full((len(sizes), wanted), -1, np.int32), np.zeros((len(sizes), wanted))
    feature[at], cut[at] = lists.flatten().to_numpy(), found["cut"].combine_chunks().flatten().to_numpy()
    feature, cut = feature[order], cut[order]
    ends = np.searchsorted(tree[order], np.arange(len(forest.trees) + 1))
    return [(whole[a:b], feature[a:b], cut[a:b]) for a, b in zip(ends, ends[1:])]


def level_splits(rows: DataFrame, sent, tries, least: int, width: int, shards: int) -> pa.Table:
    """(t, node, feature, cut): the cut each node takes of those it tries; none if it stays a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for x, y in _blocks(batches, width):
            for t, own, place in _open_rows(forest, x):
                _, feature, cut = tries.value[t]
                some = feature[place, 0] >= 0
                own, place = own[some], place[some]
                if not len(own):
                    continue
                nodes, short = np.unique(place, return_inverse=True)
                left = np.zeros((len(nodes), feature.shape[1], 2), np.int64)
                for k in range(feature.shape[1]):
                    under = (feature[place, k] >= 0) & (x[own, feature[place, k]] <= cut[place, k])
                    cells = np.bincount(2 * short[under] + y[own[under]], minlength=2 * len(nodes))
                    left[:, k] = cells.reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(nodes), t, np.int32)), pa.array(nodes + forest.first[t]), _lists(left.reshape(len(nodes), -1))], ["t", "node", "left"]
                )

    def choose(table: pa.Table) -> pa.Table:
        order, nodes, starts = _sorted_nodes(table)
        t = table["t"][0].as_py()
        whole, feature, cut = (a[nodes - sent.value.first[t]] for a in tries.value[t])
        left = np.add.reduceat(_matrix(table["left"], 2 * feature.shape[1])[order], starts).reshape(*feature.shape, 2)
        taken, chosen, border = _chosen(whole, feature, cut, left, least)
        columns = np.full(len(nodes), t, np.int32), nodes, chosen, border
        return pa.table({name: pa.array(c[taken]) for name, c in zip(("t", "node", "feature", "cut"), columns)})

    parts = rows.mapInArrow(run, "t int, node bigint, left array<bigint>")
    return _by_node(parts, shards).applyInArrow(lambda table: choose(table), "t int, node bigint, feature int, cut double").toArrow()


def grow_tree(seed: int, number: int, x: np.ndarray, y: np.ndarray, wanted: int, least: int, deepest: int | None) -> dict[str, np.ndarray]:
    """A whole tree from the rows of a task: x holds a feature a row. Rows are kept in the order of their nodes."""
    forest = Forest(1)
    (tree,) = forest.trees
    rows, starts, depth = np.arange(x.shape[1], dtype=np.int32), np.zeros(1, np.int64), 0
    while forest.open():
        first = forest.first[0]
        sizes = np.diff(np.append(starts, len(rows)))
        ones = np.add.reduceat(y[rows], starts)
        whole = np.column_stack((sizes - ones, ones))
        tree["share"][first:] = ones / sizes
        opens = (deepest is None or depth < deepest) & (whole.min(axis=1) > 0) & (sizes >= 2 * least)
        open_nodes = np.flatnonzero(opens)
        rows, sizes, whole = rows[np.repeat(opens, sizes)], sizes[opens], whole[opens]
        feature, cut = np.full((len(sizes), wanted), -1, np.int32), np.zeros((len(sizes), wanted))
        if len(sizes):
            starts = np.cumsum(sizes) - sizes
            low, high = np.empty((len(sizes), len(x))), np.empty((len(sizes), len(x)))
            for f, column in enumerate(x):
                own = column[rows]
                low[:, f], high[:, f] = np.minimum.reduceat(own, starts), np.maximum.reduceat(own, starts)
            for i, node in enumerate((first + open_nodes).tolist()):
                for k, pair in enumerate(tried(seed, number, node, low[i], high[i], wanted)):
                    feature[i, k], cut[i, k] = pair
        some = feature[:, 0] >= 0
        if not some.any():
            forest.split(NO_SPLITS)
            break
        left = np.zeros((len(sizes), wanted, 2), np.int64)
        for k in range(wanted):
            under = x[np.repeat(np.maximum(feature[:, k], 0), sizes), rows] <= np.repeat(cut[:, k], sizes)
            both = np.add.reduceat(np.column_stack((under, under & (y[rows] == 1))).astype(np.int64), starts)
            left[:, k] = np.column_stack((both[:, 0] - both[:, 1], both[:, 1])) * (feature[:, k] >= 0)[:, None]
        taken, chosen, border = _chosen(whole, feature, cut, left, least)
        forest.split(pa.table({
            "t": np.zeros(int(taken.sum()), np.int32), "node": first + open_nodes[taken], "feature": chosen[taken], "cut": border[taken],
        }))
        rows, sizes = rows[np.repeat(taken, sizes)], sizes[taken]
        # the children in order, each with its rows in the order they had
        above = x[np.repeat(chosen[taken], sizes), rows] > np.repeat(border[taken], sizes)
        child = 2 * np.repeat(np.arange(len(sizes)), sizes) + above
        rows = rows[np.argsort(child, kind="stable")]
        counts = np.bincount(child, minlength=2 * len(sizes))
        starts = np.cumsum(counts) - counts
        depth += 1
    return tree


def _parts(number: int, tree: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of the forest's table."""
    for part, low in enumerate(range(0, len(tree["feature"]), NODES)):
        lists = [pa.array([tree[name][low : low + NODES].astype(kind)]) for name, kind in KINDS.items()]
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part], pa.int32()), *lists], ["t", "part", *KINDS])


def grow_in_tasks(rows: DataFrame, path: str, count: int, n: int, width: int, seed: int, wanted: int, least: int, deepest: int | None) -> None:
    """Write the trees, each grown by a task that all rows are dealt to."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(low, PACK_ROWS)
                x = np.asarray(part.column(0).flatten()).reshape(-1, width)
                y = np.asarray(part.column(1)).astype(np.int8)
                cells = [pa.array([c], pa.binary()) for c in (x.tobytes(), y.tobytes())]
                yield pa.RecordBatch.from_arrays(cells, ["x", "y"])

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, filled = np.empty((width, n)), np.empty(n, np.int64), 0
        for batch in batches:
            for i in range(batch.num_rows):
                t, own = batch.column(0)[i].as_py(), np.frombuffer(batch.column(2)[i].as_py(), np.int8)
                x[:, filled : filled + len(own)] = np.frombuffer(batch.column(1)[i].as_py()).reshape(-1, width).T
                y[filled : filled + len(own)] = own
                filled += len(own)
                if filled == n:  # the last block of this tree: the next one is another's
                    yield from _parts(t, grow_tree(seed, t, x, y, wanted, least, deepest))
                    filled = 0

    blocks = materialize(rows.mapInArrow(packed, "x binary, y binary"), "extra-trees")
    some = max(1, DEALT_BYTES // (8 * n * width))
    for first in range(0, count, some):
        numbers = F.explode(F.sequence(F.lit(first), F.lit(min(count, first + some) - 1)))
        dealt = blocks.select(numbers.alias("t"), "x", "y").repartition(min(some, count), "t").sortWithinPartitions("t")
        dealt.mapInArrow(grown, FOREST).write.mode("append").parquet(path)


def grow_by_level(rows: DataFrame, path: str, count: int, n: int, width: int, seed: int, wanted: int, least: int, deepest: int | None) -> None:
    """Write the trees, one after the other, each grown by two jobs a level."""
    spark, shards = rows.sparkSession, 1 + n // BLOCK_ROWS
    for number in range(count):
        forest, depth = Forest(1, number), 0
        while forest.open():
            sent = spark.sparkContext.broadcast(forest)
            grows = deepest is None or depth < deepest
            found = level_tries(rows, sent, seed, wanted, least, grows, width, shards)
            tries = _padded(found, forest, wanted)
            for tree, first, (whole, _, _) in zip(forest.trees, forest.first, tries):
                tree["share"][first:] = whole[:, 1] / whole.sum(axis=1)
            some = any((feature >= 0).any() for _, feature, _ in tries)
            asked = spark.sparkContext.broadcast(tries)
            splits = level_splits(rows, sent, asked, least, width, shards) if some else NO_SPLITS
            forest.split(splits)
            sent.destroy()
            asked.destroy()
            depth += 1
        for part in _parts(number, forest.trees[0]):
            spark.createDataFrame(pa.Table.from_batches([part])).to(StructType.fromDDL(FOREST)).write.mode("append").parquet(path)


class Trees(Sequence):
    """The trees of a written forest as lists; one is read at a time."""

    def __init__(self, path: str, count: int):
        self.path, self.count = path, count

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, number: int) -> dict[str, list]:
        if not 0 <= number < self.count:
            raise IndexError(number)
        tree = _read(SparkSession.active(), self.path, number, number + 1)[0]
        return {name: values.tolist() for name, values in (tree | {"right": np.where(tree["left"] >= 0, tree["left"] + 1, -1)}).items()}

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Sequence) and len(self) == len(other) and all(a == b for a, b in zip(self, other))


def _read(spark: SparkSession, path: str, first: int, end: int) -> list[dict[str, np.ndarray]]:
    """Trees first to end - 1 of the table at `path`."""
    table = spark.read.schema(FOREST).parquet(path).where((F.col("t") >= first) & (F.col("t") < end)).toArrow()
    found: list[list] = [[] for _ in range(first, end)]
    for i in np.lexsort((table["part"].to_numpy(), table["t"].to_numpy())).tolist():
        found[table["t"][i].as_py() - first].append({name: np.asarray(table[name][i].values) for name in KINDS})
    return [{name: np.concatenate([p[name] for p in parts]) for name in KINDS} for parts in found]


def _sent_trees(sent) -> list[dict[str, np.ndarray]]:
    """Value of a broadcast, which the worker does not keep where it can read it again."""
    path = getattr(sent, "_path", None)
    return sent.load_from_path(path) if path and not hasattr(sent, "_value") else sent.value


class ExtraTreesModel(_Fitted):
    """Mean over the trees of the share of class 1 in the leaf; the trees are in a table in the shared folder."""

    def fitted(self):
        state = super().fitted()
        return state | {"trees": Trees(state["path"], state["count"])}

    def _broadcasts(self, spark: SparkSession) -> list:
        """The forest, some trees a broadcast; the driver holds one of them at a time."""
        context = spark.sparkContext
        if getattr(self, "_held", (None, None))[0] != context.applicationId:
            path, count = self.fitted()["path"], len(self.fitted()["trees"])
            sizes = spark.read.schema(FOREST).parquet(path).groupBy("t").agg(F.sum(F.size("feature")).alias("n"))
            nodes = {r["t"]: r["n"] for r in sizes.collect()}  # a number a tree
            held, first, size = [], 0, 0
            for number in range(count):
                size += 24 * nodes[number]
                if size >= SENT_BYTES or number == count - 1:
                    held.append(context.broadcast(_read(spark, path, first, number + 1)))
                    first, size = number + 1, 0
            self._held = (context.applicationId, held)
        return self._held[1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held, count = self._broadcasts(dataset.sparkSession), self.fitted()["count"]

        @F.pandas_udf("double")
        def mean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for group in _gathered(parts, BLOCK_ROWS):
                rows = [np.stack(p.to_list()) if len(p) else np.zeros((0, 1)) for p in group]
                totals = [np.zeros(len(r)) for r in rows]
                for sent in held:
                    for tree in _sent_trees(sent):
                        for r, total in zip(rows, totals):
                            total += tree["share"][_route(tree, r)]
                yield from (pd.Series(total / count) for total in totals)

        scored = dataset.withColumn("_p", mean(vector_to_array("features")))
        vector = array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))
        return scored.withColumns(
            {"rawPrediction": vector, "probability": vector, "prediction": (F.col("_p") > 0.5).cast("double")}
        ).drop("_p")


def _gathered(parts: Iterator[pd.Series], rows: int) -> Iterator[list[pd.Series]]:
    """Batches in groups that reach so many rows."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= rows:
            yield held
            held, n = [], 0
    if held:
        yield held


class ExtraTrees(BinaryEstimator):
    """Settings: n_estimators, max_depth, min_samples_leaf, max_features (sqrt, log2 or None for all), random_state."""

    def _fit(self, dataset: DataFrame) -> ExtraTreesModel:
        count, deepest = self.setting("n_estimators", 100), self.setting("max_depth", None)
        least, seed = self.setting("min_samples_leaf", 1), self.setting("random_state", 0)
        spark, label = dataset.sparkSession, F.col(self.getLabelCol()).cast("int")
        rows = materialize(dataset.select(vector_to_array("features").alias("x"), label.alias("y")), "extra-trees")
        about = rows.agg(F.max(F.size("x")).alias("width"), F.count("*").alias("n")).first()
        width, n = about["width"], about["n"]
        if not width:
            raise ValueError("There are no training rows.")
        wanted = {"sqrt": int(math.sqrt(width)), "log2": int(math.log2(width)), None: width}[self.setting("max_features", "sqrt")]
        path = new_workspace(spark, "forest")
        if 8 * n * width <= TASK_BYTES:
            grow = grow_in_tasks
        else:
            grow = grow_by_level
            # as many partitions as rows fill, but work for all cores: every level reads them twice
            parts = max(1 + n // BLOCK_ROWS, min(default_buckets(spark), 1 + n // LEAST_ROWS))
            rows = materialize(rows.repartition(parts), "extra-trees")
        grow(rows, path, count, n, width, seed, max(1, wanted), least, deepest)
        return ExtraTreesModel({"path": path, "count": count})
