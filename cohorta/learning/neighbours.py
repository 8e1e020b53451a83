"""Exact k-nearest-neighbour classification without comparing all pairs.

Training points collapse to distinct vectors and are cut into the cells of a k-d tree, whose cuts come from a bounded
sample; they only balance the work. A query first searches its own cell; the k-th distance found there bounds how
far a closer point can lie, so it visits only the other cells whose box of points reaches into that distance. A box
is never farther than a point in it, so no neighbour can be missed. Cells with many points and cells with many
queries are split, so a task holds a bounded block of each. Inside a block the same is done again: points and queries are
cut into small leaves, a batch of queries visits the leaves from the nearest on, until the k-th distance rules out the
rest, and compares those by a matrix product first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.learning.classifiers import BinaryEstimator
from cohorta.learning.stages import _Fitted
from cohorta.session import default_buckets, materialize, new_workspace

POINTS_PER_TASK = 20_000
QUERIES_PER_TASK = 20_000
CELLS_PER_BLOCK = 2_000_000  # distances to boxes held at once inside a task
SAMPLE = 65_536  # points that the cuts of the cells come from
LEAF = 256  # points or queries of a leaf

SEEDS = 2_048  # points that bound a query's k-th distance first

CELL = "_cell"
_FOUND = "q bigint, distance double, n bigint, pos bigint"


def cell_cuts(sample: np.ndarray, depth: int) -> list[list[float]]:
    """[feature, border] of every inner node of a k-d tree, level by level; a border belongs to the left side."""
    cuts, level = [], [sample]
    for _ in range(depth):
        after = []
        for rows in level:
            feature, border = 0, 0.0
            if len(rows):
                feature = int(np.argmax(np.ptp(rows, axis=0)))
                border = float(np.partition(rows[:, feature], (len(rows) - 1) // 2)[(len(rows) - 1) // 2])
            cuts.append([feature, border])
            left = rows[:, feature] <= border if len(rows) else np.zeros(0, bool)
            after += [rows[left], rows[~left]]
        level = after
    return cuts


def cells_of(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Cell of each row; a value that is no number goes left."""
    feature, border = np.array([f for f, _ in cuts], np.int64), np.array([b for _, b in cuts])
    at, first = np.zeros(len(x), np.int64), 0
    while first < len(cuts):
        node = first + at
        first = 2 * first + 1
        at = 2 * at + (x[np.arange(len(x)), feature[node]] > border[node])
    return at


def _gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from each row to each box, (rows, boxes); one that is no number is no reason to leave a box out."""
    total = np.zeros((len(x), len(low)))
    for f in range(x.shape[1]):
        own = x[:, f, None]
        total += np.maximum(np.maximum(low[None, :, f] - own, own - high[None, :, f]), 0) ** 2
    return np.nan_to_num(total, nan=0.0, posinf=np.inf)


def _squared(limit: np.ndarray) -> np.ndarray:
    """Square of a bound with a slack for rounding."""
    return limit**2 * (1 + 1e-12)


def with_cell(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        return pd.Series(cells_of(np.stack(x.to_list()), cuts) if len(x) else [], dtype="int32")

    return rows.withColumn(CELL, cell("x") if cuts else F.lit(0))


def _candidates(at: np.ndarray, among: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of all pairs that can be among a query's k nearest within its limit.

    A matrix product gives all squared distances up to rounding; pairs beyond the limit and a slack for that are
    left out, the distances of the others are summed feature by feature.
    """
    own, other = (at**2).sum(axis=1), (among**2).sum(axis=1)
    slack = 1e-10 * (own[:, None] + other[None, :])
    squares = own[:, None] + other[None, :] - 2 * (at @ among.T)
    most = limit**2 * (1 + 1e-12)
    if not np.isfinite(most).all() and len(among) >= k:
        first = max(SEEDS, 4 * k)
        seeds = squares[:, :first] + slack[:, :first]
        most = np.minimum(most, np.partition(seeds, k - 1, axis=1)[:, k - 1])
    # what overflows is compared feature by feature, too
    i, j = np.nonzero((squares <= most[:, None] + slack) | ~np.isfinite(squares))
    exact = np.zeros(len(i))
    for feature in range(at.shape[1]):
        exact += (at[i, feature] - among[j, feature]) ** 2
    return i, j, np.sqrt(exact)


def leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in groups of at most `size` that lie together: halves along the widest feature, again and again."""
    todo, done = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            done.append(rows)
            continue
        own, half = x[rows], len(rows) // 2
        spread = np.nan_to_num(own.max(axis=0) - own.min(axis=0), nan=0.0)
        order = np.argpartition(own[:, int(np.argmax(spread))], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return done


def _search_batch(at: np.ndarray, bound: np.ndarray, among: np.ndarray, parts: list[np.ndarray], low: np.ndarray, high: np.ndarray, k: int):
    """(query, point, distance) of all pairs that can be among the k nearest of a batch of queries that lie together."""
    limit, best = bound.copy(), np.full((len(at), k), np.inf)
    middle = (at.min(axis=0) + at.max(axis=0)) / 2
    reach = np.maximum(np.maximum(low - at.max(axis=0), at.min(axis=0) - high), 0)
    reach = np.nan_to_num((reach**2).sum(axis=1), nan=0.0, posinf=np.inf)
    found = []
    for part in np.lexsort((np.abs((low + high) / 2 - middle).sum(axis=1), reach)).tolist():
        if reach[part] > _squared(limit.max()):
            break
        near = np.flatnonzero(~(_gaps(at, low[part : part + 1], high[part : part + 1])[:, 0] > _squared(limit)))
        if not len(near):
            continue
        i, j, distance = _candidates(at[near], among[parts[part]], limit[near], k)
        close = ~(distance > limit[near][i])
        i, j, distance = near[i[close]], parts[part][j[close]], distance[close]
        found.append((i, j, distance))
        order = np.lexsort((distance, i))
        i, distance = i[order], distance[order]
        asked, first, count = np.unique(i, return_index=True, return_counts=True)
        rank = np.arange(len(i)) - np.repeat(first, count)
        new = np.full((len(asked), k), np.inf)
        new[np.repeat(np.arange(len(asked)), count)[rank < k], rank[rank < k]] = distance[rank < k]
        best[asked] = np.sort(np.concatenate((best[asked], new), axis=1), axis=1)[:, :k]
        limit = np.minimum(limit, best[:, -1])
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(rows, -1)


def _nearest(k: int):
    """Function of one (queries, points) block: per query the k smallest distances, ties pooled."""

    def search(queries: pa.Table, points: pa.Table) -> pa.Table:
        found = []
        if len(queries) and len(points):
            at, among = _matrix(queries["x"], len(queries)), _matrix(points["x"], len(points))
            bound, q = queries["bound"].to_numpy(), queries["q"].to_numpy()
            n, pos = points["n"].to_numpy(), points["pos"].to_numpy()
            parts = leaves(among, max(LEAF, 2 * k))
            low, high = (np.stack([side(among[p], axis=0) for p in parts]) for side in (np.min, np.max))
            for batch in leaves(at, LEAF):
                i, j, distance = _search_batch(at[batch], bound[batch], among, parts, low, high, k)
                order = np.lexsort((distance, i))
                i, j, distance = i[order], j[order], distance[order]
                asked, first, count = np.unique(i, return_index=True, return_counts=True)
                last = distance[first + np.minimum(k, count) - 1]
                close = distance <= np.repeat(np.minimum(last, bound[batch][asked]), count)
                i, j, distance = i[close], j[close], distance[close]
                if not len(i):
                    continue
                new = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (distance[1:] != distance[:-1])))
                found.append((q[batch][i[new]], distance[new], np.add.reduceat(n[j], new), np.add.reduceat(pos[j], new)))
        kinds = np.int64, np.float64, np.int64, np.int64
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, kind) for kind in kinds]
        return pa.table(dict(zip(("q", "distance", "n", "pos"), columns)))

    return search


def _closest(found: DataFrame, k: int) -> DataFrame:
    """Neighbours by rising distance with ``taken``: how many of the k places a distance fills.

    A query has at most k distances per visited block, so its window stays small.
    """
    pooled = found.groupBy("q", "distance").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    rising = W.partitionBy("q").orderBy("distance").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(rising), F.lit(0))
    taken = F.least(F.col("n"), F.greatest(F.lit(k) - before, F.lit(0)))
    return pooled.withColumn("taken", taken).where("taken > 0")


class NeighboursModel(_Fitted):
    """Votes of the nearest training points; points tied at the last place share it."""

    def _search(self, queries: DataFrame, points: DataFrame, parts: DataFrame) -> DataFrame:
        """Search the cell each (q, x, cell, bound) query names."""
        per_cell = queries.groupBy(CELL).agg(
            F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("chunks")
        ).join(parts, CELL)
        part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        asked = (
            queries.join(per_cell, CELL)
            .withColumn("chunk", F.pmod(F.xxhash64("q"), F.col("chunks")).cast("int"))
            .select("q", "x", "bound", CELL, "chunk", part.alias("part"))
        )
        offered = points.join(per_cell.select(CELL, "chunks"), CELL).select(
            "x", "n", "pos", CELL, "part", chunk.alias("chunk")
        )
        block = [CELL, "part", "chunk"]
        search = _nearest(self.fitted()["k"])
        return (
            asked.groupBy(*block)
            .cogroup(offered.groupBy(*block))
            .applyInArrow(lambda queries, points: search(queries, points), _FOUND)
        )

    def votes(self, vectors: DataFrame) -> DataFrame:
        """(x, p) for distinct vectors ``x``."""
        state = self.fitted()
        spark = vectors.sparkSession
        k, cuts = state["k"], state["cuts"]
        points = spark.read.parquet(f"{state['path']}/points")
        parts = spark.read.parquet(f"{state['path']}/parts")
        # written, so that a vector keeps its number; the neighbours found are told apart by it
        known = materialize(with_cell(vectors.withColumn("q", F.monotonically_increasing_id()), cuts), "asked")
        near = self._search(known.withColumn("bound", F.lit(float("inf"))), points, parts)
        near = materialize(near, "near")
        reach = _closest(near, k).groupBy("q").agg(
            F.max("distance").alias("reach"), F.sum("taken").alias("places")
        )
        # a full set of k places bounds the search; a slack covers rounding
        bound = F.when(F.col("places") >= k, F.col("reach") * (1 + 1e-9) + 1e-9).otherwise(float("inf"))
        # a query without points in its own cell has no row in `reach`
        ranged = known.join(reach.select("q", bound.alias("bound")), "q", "left").fillna(float("inf"), ["bound"])
        sent = spark.sparkContext.broadcast(_boxes(spark.read.parquet(f"{state['path']}/boxes")))

        @F.pandas_udf("array<int>")
        def reached(x: pd.Series, bound: pd.Series) -> pd.Series:
            cells, low, high = sent.value
            found, step = [], max(1, CELLS_PER_BLOCK // len(cells))
            for first in range(0, len(x), step):
                own = slice(first, first + step)
                inside = _gaps(np.stack(x[own].to_list()), low, high) <= _squared(bound[own].to_numpy())[:, None]
                found += [cells[row] for row in inside]
            return pd.Series(found)

        elsewhere = ranged.select(
            "q", "x", "bound", F.col(CELL).alias("_home"), F.explode(reached("x", "bound")).alias(CELL)
        ).where(F.col("_home") != F.col(CELL))
        found = near.unionByName(self._search(materialize(elsewhere.drop("_home"), "elsewhere"), points, parts))
        chosen = _closest(found, k)
        share = F.col("taken") * F.col("pos") / F.col("n")
        if state["weights"] == "distance":
            exact = F.max(F.col("distance") == 0)
            at_zero = F.sum(F.when(F.col("distance") == 0, share)) / F.sum(
                F.when(F.col("distance") == 0, F.col("taken"))
            )
            inverse = 1 / F.nullif(F.col("distance"), F.lit(0.0))
            weighted = F.sum(share * inverse) / F.sum(F.col("taken") * inverse)
            vote = F.when(exact, at_zero).otherwise(weighted)
        else:
            vote = F.sum(share) / F.sum("taken")
        return known.join(chosen.groupBy("q").agg(vote.alias("_p")), "q").drop("q", CELL)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = dataset.withColumn("x", vector_to_array("features"))
        scored = rows.join(self.votes(rows.select("x").distinct()), "x", "left")
        vector = array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))
        return scored.withColumns(
            {"rawPrediction": vector, "probability": vector, "prediction": (F.col("_p") > 0.5).cast("double")}
        ).drop("x", "_p")


def _cell_boxes(points: DataFrame) -> DataFrame:
    """(cell, low, high): smallest and largest values of the points of each cell."""
    schema = f"{CELL} int, low array<double>, high array<double>"

    def sides(cell: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Table:
        order = np.argsort(cell, kind="stable")
        cells, starts = np.unique(cell[order], return_index=True)
        lists = [pa.array(list(side.reduceat(x[order], starts))) for side, x in ((np.minimum, low), (np.maximum, high))]
        return pa.table([pa.array(cells.astype(np.int32)), *lists], [CELL, "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)
                yield from sides(np.asarray(batch.column(0)), x, x).to_batches()

    def join(rows: pa.Table) -> pa.Table:
        return sides(rows[CELL].to_numpy(), _matrix(rows["low"], len(rows)), _matrix(rows["high"], len(rows)))

    return points.select(CELL, "x").mapInArrow(run, schema).groupBy(CELL).applyInArrow(lambda rows: join(rows), schema)


def _boxes(table: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells and their boxes; a cell has thousands of points."""
    rows = table.orderBy(CELL).toArrow()
    return rows[CELL].to_numpy(), _matrix(rows["low"], len(rows)), _matrix(rows["high"], len(rows))


class NearestNeighbours(BinaryEstimator):
    """Keeps the distinct training vectors, in cells, as a table in the shared folder."""

    def _fit(self, dataset: DataFrame) -> NeighboursModel:
        spark = dataset.sparkSession
        k, weights = self.setting("n_neighbors", 5), self.setting("weights", "uniform")
        if weights not in {"uniform", "distance"}:
            raise ValueError(f"Unknown vote weighting {weights!r}.")
        folder = new_workspace(spark, "neighbours")
        label = F.col(self.getLabelCol())
        points = (
            dataset.select(vector_to_array("features").alias("x"), label.alias("y"))
            .groupBy("x")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("pos"))
        )
        points.write.parquet(f"{folder}/distinct")
        points = spark.read.parquet(f"{folder}/distinct")
        count = points.count()
        # cells that fill half a task, but work for all cores; no more than leave each several times k points
        wanted = max(2 * count // POINTS_PER_TASK, min(default_buckets(spark), 4 * spark.sparkContext.defaultParallelism))
        wanted = max(1, min(wanted, count // (4 * k), SAMPLE // 8))
        some = points.where(F.pmod(F.xxhash64("x"), F.lit(-(-count // SAMPLE))) == 0) if count > SAMPLE else points
        sample = some.select("x").limit(2 * SAMPLE).toArrow()
        cuts = cell_cuts(_matrix(sample["x"], len(sample)), wanted.bit_length() - 1)
        celled = materialize(with_cell(points, cuts), "celled")
        parts = celled.groupBy(CELL).agg(
            F.ceil(F.count(F.lit(1)) / POINTS_PER_TASK).cast("int").alias("parts")
        )
        parts.write.parquet(f"{folder}/parts")
        parts = spark.read.parquet(f"{folder}/parts")
        _cell_boxes(celled).write.parquet(f"{folder}/boxes")
        celled.join(parts, CELL).withColumn(
            "part", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int")
        ).drop("parts").write.parquet(f"{folder}/points")
        return NeighboursModel({"path": folder, "k": k, "weights": weights, "cuts": cuts})
