"""Near-duplicate documents by Order MinHash.

A text is its sequence of shingles of five words; a shingle's k-th occurrence is labelled k, so the
sequence has no repeats. One sketch keeps the `keep` labelled shingles that come first in a random
order and hashes them in text order: two texts share it with a probability that falls with the
edit distance of their sequences, not only of their sets. `sketches` random orders give as many
buckets a text is in. Short texts, where one change is a large share, take fewer shingles a sketch.

Texts in a bucket are compared by a banded alignment of the two sequences; with `m` the length of the
best alignment, the similarity is m / (n1 + n2 - m), and 0.8 or more is a link. Comparing all pairs
of a bucket is avoided in two steps that lose no link between classes. First every text meets the
first text of its bucket; what these links join is one class already. Buckets with texts of
several classes are left. Of these texts a pair of different classes can only be similar if the two
share a shingle among the first n - needed + 1 of each, rarest shingles first (`needed` shingles
must align); so these prefixes are joined, not the buckets, and a group of thousands of
copies with many changes each does not meet itself pair by pair. Documents of equal texts, or texts
equal up to case and characters outside words, meet as one text.

Nothing but counters comes to the driver; sketches, links and classes are tables in the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch, null_safe, sent_if_few, text_bytes
from cohorta.llm.components import components
from cohorta.llm.words import find_words, mix

SHINGLE = 5
SIMILAR = 0.8
#: shingles a sketch, sketches, and from how many (up to how many) shingles a text takes them
LONG = (10, 56, 64, None)
SHORT = (4, 24, 0, 80)  # 0.8 * 80 = 64: similar texts always share a family
_COEFFICIENTS = [mix(np.array([i + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0] | np.uint64(1) for i in range(SHINGLE)]


def labelled_shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles in text order, each mixed with its occurrence number; under five words make one."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(SHINGLE, n)
    shingles = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        shingles += words[i : n - width + 1 + i] * _COEFFICIENTS[i]
    mix(shingles)
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    if not fresh.all():
        at = np.arange(len(order))
        label = np.empty(len(order), np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
        shingles = np.where(label > 0, mix(shingles + label * np.uint64(0xD6E8FEB86659FD93)), shingles)
    return shingles


def _seeds(count: int, family: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(family))


def _family_keys(shingles: np.ndarray, keep: int, count: int, family: int) -> np.ndarray:
    seeds, n = _seeds(count, family), len(shingles)
    keep = min(keep, n)
    keys = np.empty(count, np.uint64)
    rows = max(1, (1 << 17) // n)
    for low in range(0, count, rows):
        part = seeds[low : low + rows]
        order = (shingles[None] ^ part[:, None]) * np.uint64(0xE7037ED1A0B428DB)
        order ^= order >> np.uint64(32)
        order *= np.uint64(0x8EBC6AF09C88C6E3)
        if keep < n:
            limit = np.partition(order, keep - 1, axis=1)[:, keep - 1 : keep]
            chosen = np.broadcast_to(shingles, order.shape)[order <= limit]
        else:
            chosen = np.broadcast_to(shingles, order.shape).ravel()
        if len(chosen) != keep * len(part):  # two equal hashes at the limit
            chosen = np.concatenate([shingles[np.sort(np.argsort(o, kind="stable")[:keep])] for o in order])
        folded = part.copy()
        for column in chosen.reshape(len(part), keep).T:
            folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + column)
        keys[low : low + rows] = folded
    return keys


def sketch_keys(shingles: np.ndarray) -> np.ndarray:
    """Bucket keys of a text; equal texts have equal keys."""
    parts = []
    for family, (keep, count, least, most) in enumerate((LONG, SHORT)):
        if len(shingles) and len(shingles) >= least and (most is None or len(shingles) < most):
            parts.append(_family_keys(shingles, keep, count, family))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Similarity by banded alignment of two sequences without repeats; 0 if it is under `least`.

    To be similar, at least m = least / (1 + least) * (n1 + n2) shingles align, so no aligned pair lies
    further than n1 + n2 - 2 m from the diagonal: only matches within that band are used.
    """
    total = len(a) + len(b)
    if not total:
        return 0.0
    needed = math.ceil(least / (1 + least) * total - 1e-9)
    if min(len(a), len(b)) < needed:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= total - 2 * needed
    at_a, at_b = at_a[near], at_b[near]
    if len(at_a) < needed:
        return 0.0
    steps = at_b[np.argsort(at_a)]
    if (np.diff(steps) > 0).all():
        best = len(steps)
    else:
        tails: list[int] = []
        for x in steps.tolist():
            k = bisect_left(tails, x)
            tails[k : k + 1] = [x]
        best = len(tails)
    return best / (total - best) if best >= needed else 0.0


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    blob, offsets = text_bytes(batch.column(name))
    words = find_words(blob, offsets)
    for i in range(len(offsets) - 1):
        yield words.hashes[words.bounds[i] : words.bounds[i + 1]]


def _node(words: np.ndarray, tkey: str | None) -> int | None:
    """120 bits that name a text: its words, or the whole text if it has none. A null text has no node."""
    if tkey is None:
        return None
    raw = hashlib.blake2b(words.tobytes(), digest_size=15).digest() if len(words) else bytes.fromhex(tkey)[:15]
    return int.from_bytes(raw, "big")


NODE = pa.decimal128(38, 0)


def _nodes(values: list[int | None]) -> pa.Array:
    return pa.array([None if v is None else Decimal(v) for v in values], NODE)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, node, x, keys) of (doc_id, text): text digest, name of the words (x: 64 bits of it), bucket keys."""
    wide = docs.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("tkey"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys = [], []
            for words, tkey in zip(_texts(batch, "text"), batch.column("tkey").to_pylist(), strict=True):
                nodes.append(_node(words, tkey))
                keys.append(sketch_keys(labelled_shingles(words)).view(np.int64))
            sizes = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tkey"),
                    _nodes(nodes),
                    pa.array([None if v is None else (v >> 56) - (1 << 63) for v in nodes], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(sizes), flat),
                ],
                ["doc_id", "tkey", "node", "x", "keys"],
            )

    kind = wide.schema["doc_id"].dataType.simpleString()
    return wide.mapInArrow(run, f"doc_id {kind}, tkey string, node decimal(38,0), x bigint, keys array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame, key: str, least: float) -> DataFrame:
    """(a, b): nodes of those of the pairs (p, q) of keys whose texts align. texts: (x, node, text)."""
    left = texts.select(F.col(key).alias("p"), F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col(key).alias("q"), F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "p").join(right, "q").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cache: dict[Decimal, np.ndarray] = {}
            good = []
            a_ids, b_ids = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for a, b, wa, wb in zip(a_ids, b_ids, _texts(batch, "text_a"), _texts(batch, "text_b"), strict=True):
                for node, words in ((a, wa), (b, wb)):
                    if node not in cache:
                        cache[node] = labelled_shingles(words)
                good.append(aligned(cache[a], cache[b], least) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a decimal(38,0), b decimal(38,0)")


def _shingles(texts: DataFrame) -> DataFrame:
    """(node, class, stray, n, token): every labelled shingle, as a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [labelled_shingles(words).view(np.int64) for words in _texts(batch, "text")]
            sizes = np.array([len(f) for f in found])
            rows = batch.select(["node", "class", "stray"]).take(pa.array(np.repeat(np.arange(len(found)), sizes)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(np.repeat(sizes, sizes), pa.int64()), pa.array(np.concatenate(found))],
                ["node", "class", "stray", "n", "token"],
            )

    wide = texts.select("node", "class", "stray", "text")
    return wide.mapInArrow(run, "node decimal(38,0), class decimal(38,0), stray boolean, n bigint, token bigint")


def _prefix_pairs(texts: DataFrame, least: float) -> DataFrame:
    """Pairs (p, q), p < q, of nodes of different classes, one a stray, whose prefixes share a shingle."""
    tokens = _shingles(texts)
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # shingles that no other text has come first, and meet nothing: only their number matters
    common = tokens.join(counts, "token")
    order = W.partitionBy("node").orderBy("df", "token")
    last = W.partitionBy("node")
    place = F.col("n") - F.count("*").over(last) + F.row_number().over(order)
    placed = common.withColumn("place", place).where(
        F.col("place") <= F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1
    )
    s = placed.where("stray").select(
        "token", F.col("node").alias("s"), F.col("class").alias("s_class"), F.col("n").alias("s_n"), F.col("place").alias("s_at")
    )
    needed = F.ceil(least / (1 + least) * (F.col("s_n") + F.col("n")) - 1e-9)
    met = s.join(placed, "token").where(
        (F.col("s_class") != F.col("class"))
        & (~F.col("stray") | (F.col("s") < F.col("node")))
        & (F.col("s_at") <= F.col("s_n") - needed + 1)
        & (F.col("place") <= F.col("n") - needed + 1)
    )
    return met.select(F.least("s", "node").alias("p"), F.greatest("s", "node").alias("q")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILAR
) -> DataFrame:
    """(doc_id, tkey, class_id, n_links, first) of every row.

    class_id is the smallest id of the class; n_links counts the links of the row's text to
    different texts that were verified; `first` marks the row that stays: the one with the smallest
    id (then digest) of its class. Equal texts are one class, the empty one included; a null text
    is a class of its own for every row, and stays. A null id comes after all others. Rows that
    repeat id and text are marked alike.
    """
    scratch = Scratch(docs.sparkSession, "near-copies")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketches = scratch.keep(sketch(plain), "sketches")
    # one row of keys a text, however many copies it has
    once = sketches.where(F.size("keys") > 0).groupBy("x").agg(F.first("keys").alias("keys"))
    buckets = once.select(F.explode("keys").alias("key"), "x")
    heads = buckets.groupBy("key").agg(F.min("x").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = scratch.keep(buckets.join(heads.select("key", "head"), "key").select("key", "head", "x"), "shared")
    star = shared.where("x != head").select(F.col("x").alias("p"), F.col("head").alias("q")).distinct()
    # one row with its text for each text that shares a bucket
    met = scratch.keep(shared.select("x").distinct(), "met")
    carriers = sketches.join(sent_if_few(met), "x").groupBy("x", "node").agg(F.min(F.struct("doc_id", "tkey")).alias("c"))
    carriers = scratch.keep(carriers.select("x", "node", "c.doc_id", "c.tkey"), "carriers")
    with_key = plain.withColumn("tkey", F.md5(F.col("text").cast("binary")))
    few = sent_if_few(carriers)
    texts = with_key.join(few, null_safe(with_key, few, ("doc_id", "tkey"))).select("x", "node", "text")
    texts = scratch.keep(texts.dropDuplicates(["node"]), "texts")
    links = scratch.keep(_verified(star, texts, "x", least).distinct(), "star")
    classes = scratch.keep(components(links, scratch, "first"), "classes")

    # second step: texts of buckets with several classes; strays are those outside a bucket's largest class
    member = (
        shared.select("key", "x")
        .join(texts.select("x", "node"), "x")
        .join(classes.withColumnRenamed("root", "class"), "node", "left")
        .select("key", "node", F.coalesce("class", "node").alias("class"))
    )
    sizes = member.groupBy("key", "class").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "class")).alias("top"), F.count("*").alias("k"))
    mixed = member.join(largest.where("k > 1").select("key", F.col("top.class").alias("most")), "key")
    mixed = mixed.groupBy("node", "class").agg(F.max(F.col("class") != F.col("most")).alias("stray"))
    mixed = scratch.keep(texts.select("node", "text").join(mixed, "node"), "mixed")
    pairs = _prefix_pairs(mixed, least)
    cross = scratch.keep(_verified(pairs, mixed, "node", least), "cross").join(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
    )
    every = links.union(cross)
    contracted = classes.select(F.col("node").alias("a"), F.col("root").alias("b")).union(cross)
    roots = classes if cross.isEmpty() else components(contracted, scratch, "all")
    ends = every.select(F.col("a").alias("node")).union(every.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    known = roots.join(degree, "node").withColumnRenamed("root", "class")
    # a text without links is a class of its own; so is every row whose text is null
    placed = (
        sketches.select("doc_id", "tkey", "node")
        .join(known, "node", "left")
        .select(
            "doc_id",
            "tkey",
            F.coalesce("class", "node").alias("class"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
    placed = scratch.keep(placed, "placed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("tkey"))
    # classes of one row need no second look
    firsts = placed.where(F.col("class").isNotNull()).groupBy("class")
    firsts = firsts.agg(F.count("*").alias("n"), F.min(order).alias("top")).where("n > 1").drop("n")
    alone = F.col("top").isNull()
    same = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & F.col("tkey").eqNullSafe(F.col("top.tkey"))
    return placed.join(firsts, "class", "left").select(
        "doc_id",
        "tkey",
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("class_id"),
        F.col("n_links").cast("long").alias("n_links"),
        (alone | same).alias("first"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: one of each class, with all their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, own_text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    found = near_duplicates(plain, own_id, own_text).where(~F.col("first")).select("doc_id", "tkey").distinct()
    tkey = F.md5(F.col(own_text).cast("binary"))
    gone = plain[own_id].eqNullSafe(found["doc_id"]) & tkey.eqNullSafe(found["tkey"])
    kept = plain.join(found, gone, "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
