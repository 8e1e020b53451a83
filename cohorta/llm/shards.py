"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced jointly.

Rows with equal texts form a group that stays together. Groups become items with a size vector:

* a group that holds at least 1/`heavy` of all bytes, tokens or rows is an item of its own; there
  are at most 3 * `heavy` such groups, whatever the input;
* one of more than `split` of a shard's share in any dimension is dealt by id into several items,
  so that a group with a third of all rows does not make one shard;
* all other groups go by hash into `parcels` parcels.

So the number of items is bounded and only they come to the driver, largest first; each goes to the
shard with the highest dot product of its size vector and the shard's residual capacity. Rows find
their shard again by a join with the item table of bounded size. Slots count up inside hash slices
of each shard behind the sums of the slices before, so no shard is sorted in one task.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch

SIZES = ("bytes", "tokens", "rows")
WHITE = "[\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: id, text digest, bytes, tokens, rows."""
    text = F.col(text_col)
    words = F.trim(F.regexp_replace(text, WHITE, " "))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        # a null text is its own group, apart from the empty one
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("digest"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("bytes"),
        F.coalesce(
            F.when(F.length(words) > 0, F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1),
            F.lit(0),
        )
        .cast("long")
        .alias("tokens"),
        F.lit(1).cast("long").alias("rows"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )


def pack(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item: the highest dot product of size and residual capacity, largest items first."""
    total = sizes.sum(axis=0)
    scaled = sizes / np.where(total > 0, total, 1)
    order = np.argsort(-scaled.max(axis=1), kind="stable")
    residual = np.full((shards, sizes.shape[1]), 1.0 / shards)
    # an absent dimension has no say
    residual[:, total == 0] = 0
    place = np.zeros(len(sizes), np.int64)
    for i in order.tolist():
        item = scaled[i]
        best = int(np.argmax(residual @ item))
        place[i] = best
        residual[best] -= item
    return place


def assign_shards(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy: int = 16_384,
    parcels: int = 65_536,
    split: float = 0.5,
    slice_rows: int = 100_000,
) -> DataFrame:
    """doc_id, bytes, tokens, text_crc32, shard and slot of every row.

    Null and empty texts have size 1 (one byte, no token); repeated rows are rows of one group, and
    so are null ids; an empty table gives no rows. Slots are gapless from 0 in each shard; their
    order is a hash order of the ids and has no further meaning.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    rows = scratch.keep(sized(docs, id_col, text_col), "rows")
    totals = rows.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SIZES]).first()
    count = totals["rows"]
    groups = rows.groupBy("digest").agg(*[F.sum(s).alias(s) for s in SIZES])
    share = F.greatest(*[F.col(s) / max(1, totals[s]) for s in SIZES])
    large = groups.where(share * heavy >= 1)  # at most heavy groups a dimension
    pieces = F.greatest(F.lit(1), F.ceil(share * shards / split)).cast("int")
    hot = scratch.keep(large.select("digest", pieces.alias("pieces")), "heavy")

    item = F.when(F.col("pieces").isNull(), F.concat(F.lit("p"), F.pmod(F.xxhash64("digest"), F.lit(parcels)))).when(
        F.col("pieces") == 1, F.col("digest")
    )
    item = item.otherwise(
        F.concat_ws("-", "digest", F.pmod(F.xxhash64(F.col("doc_id")), F.col("pieces")).cast("string"))
    )
    placed = rows.join(F.broadcast(hot), "digest", "left").withColumn("item", item)
    items = placed.groupBy("item").agg(*[F.sum(s).alias(s) for s in SIZES]).collect()
    if not items:
        where = spark.createDataFrame([], "item string, shard int")
    else:
        items.sort(key=lambda r: r["item"])
        sizes = np.array([[r[s] for s in SIZES] for r in items], float)
        chosen = pack(sizes, shards)
        where = spark.createDataFrame(
            [(r["item"], int(s)) for r, s in zip(items, chosen, strict=True)], "item string, shard int"
        )
    slices = max(1, math.ceil(count / slice_rows))
    cut = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(slices)).cast("int")
    with_shard = placed.join(F.broadcast(where), "item").withColumn("cut", cut)
    per_cut = with_shard.groupBy("shard", "cut").agg(F.count("*").alias("n"))
    behind = per_cut.withColumn(
        "behind",
        F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("cut").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
    ).drop("n")
    number = F.row_number().over(W.partitionBy("shard", "cut").orderBy("doc_id", "digest")) - 1
    return (
        with_shard.withColumn("inner_slot", number)
        .join(behind, ["shard", "cut"])
        .select(
            "doc_id", "bytes", "tokens", "text_crc32", "shard", (F.col("behind") + F.col("inner_slot")).alias("slot")
        )
    )
