"""Helpers of this subpackage: tables in the shared folder, Arrow text columns, row identity."""

from __future__ import annotations

import os
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.session import new_workspace


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it, too."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def load(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    ready(spark)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = new_workspace(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column back to back, and the offset of each row (one more at the end).

    A null is an empty text here.
    """
    filled = pc.fill_null(column, "") if column.null_count else column
    wide = filled.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    if not len(wide) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    blob = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return blob, offsets - offsets[0]


def without(df: DataFrame, names: Sequence[str], *needed: str) -> DataFrame:
    """The frame without columns that a result's columns of these names will replace, in any case of letters."""
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken and c not in needed]
    return df.drop(*clash) if clash else df


def schema_with(df: DataFrame, *fields: str) -> str:
    """DDL of the frame's columns and more fields, for mapInArrow."""
    own = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema]
    return ", ".join([*own, *fields])


def held_out(column: str | Column, modulus: int, remainder: int = 1) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is not held out."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def fold_ascii(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Join condition over equally named columns where null meets null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def digest_number(value: Column) -> Column:
    """The first 120 bits of the MD5 digest, as a number."""
    digest = F.md5(value.cast("binary"))
    high, low = (F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(19,0)") for at in (1, 16))
    return (high * F.lit(Decimal(1 << 60)).cast("decimal(19,0)") + low).cast("decimal(38,0)")


#: keys sent to all tasks instead of joined; their number is counted first
SENT = 200_000


def sent_if_few(keys: DataFrame) -> DataFrame:
    """A written table of narrow keys, marked for broadcast if it was counted to be small."""
    return F.broadcast(keys) if keys.count() <= SENT else keys
