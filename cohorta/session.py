"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cohorta", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings this package relies on (UTC, adaptive execution)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Where the setting is missing, a folder below the session's warehouse is set, in local sessions only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    One job; the result has no lineage to recompute when executors are lost, and its size is
    known to the planner.
    """
    path = new_workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_buckets(spark: SparkSession) -> int:
    """How many slices a globally ordered computation is cut into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


_RESIZE_CACHED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def cache_balanced(df: DataFrame) -> DataFrame:
    """Keep rows for repeated passes in evenly sized partitions.

    Filters and skewed sources leave partitions of very different size, which every pass of an
    iterative fit would wait for. The rebalance hint evens them out once; small tables end up
    in few partitions, so a pass costs few tasks. Lost blocks are recomputed from the source.
    """
    spark = df.sparkSession
    before = spark.conf.get(_RESIZE_CACHED)
    spark.conf.set(_RESIZE_CACHED, "true")
    try:
        return df.hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        spark.conf.set(_RESIZE_CACHED, before)
