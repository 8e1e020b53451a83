"""Connected components of a link table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch

PART = 1_000_000  # links a partition of the written tables


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node of the component.

    Large-star and small-star steps alternate until the links no longer change; each node's links
    are only ever aggregated to a minimum, so a hub of any size is a map-side sum and a join. The
    number of rounds grows with the logarithm of the longest path. Every round is written to the
    shared folder, in as many partitions as its links fill, and the one before is removed. Nodes
    should be numbers: their minimum is then a hash aggregate.
    """
    current, mark = _kept(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), scratch, f"{name}-0")
    turn = 0
    while mark["n"]:
        # large star: larger neighbours of each node move to its smallest neighbour
        ways = _both_ways(current)
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            ways.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        # small star: a node's smaller neighbours and itself move to the smallest of them
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(root, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(root.select("a", F.col("m").alias("b")))
            .where("a != b")
            .distinct()
        )
        turn += 1
        before = mark
        current, mark = _kept(small.coalesce(1 + before["n"] // PART), scratch, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        if mark == before:
            break
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _kept(links: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, dict]:
    """The links as written, with their number and a hash of them all, read from the written table."""
    kept = scratch.keep(links, name)
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return kept, kept.agg(F.count(F.lit(1)).alias("n"), total.alias("h")).first().asDict()
