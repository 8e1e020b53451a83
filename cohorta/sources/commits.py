"""Small records committed as one file each, created only if the file is absent.

An append job of Spark shares one ``_temporary`` folder with every other job that appends to the same
path, and reads the highest number before it writes. A commit here is one file made by an exclusive
create, so of two writers that want one name exactly one gets it. Files are JSON lines: Spark reads
the folder as a table. A file without content is the claim of a writer that died; it holds no record.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATIENCE = 25  # looks at a claimed but empty commit before it counts as abandoned
PAUSE = 0.2  # seconds between two looks


def lines_of(rows: DataFrame) -> str:
    """The rows of a small record table as JSON lines, nulls included."""
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return "".join(f"{row[0]}\n" for row in rows.select(text).collect())


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; false, and nothing written, when the path is taken.

    The file system decides: an exclusive open on local disks, a create without overwriting elsewhere.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as handle:
                handle.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if files.exists(target):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def append_commit(spark: SparkSession, folder: str, rows: DataFrame) -> None:
    """Add records under a name of their own; writers never wait for each other."""
    if not create_if_absent(spark, f"{folder.rstrip('/')}/{uuid.uuid4().hex}.json", lines_of(rows)):
        raise FileExistsError(folder)


def numbered_commit(
    spark: SparkSession, name: Callable[[int], str], look: Callable[[], tuple[int, object]],
    build: Callable[[int, object], DataFrame],
) -> int:
    """Commit under the number after the last one and return the number.

    ``look`` reads the last number and what a record depends on at once; ``build`` makes the record from
    both. A number that was taken meanwhile means that another commit came between, so everything is read
    and built again. A claim that stays empty is passed over.
    """
    passed, same, before = 0, 0, None
    while True:
        last, state = look()
        if last != before:
            passed, same, before = 0, 0, last
        number = last + 1 + passed
        if create_if_absent(spark, name(number), lines_of(build(number, state))):
            return number
        same += 1
        if same % PATIENCE == 0:
            passed += 1
        time.sleep(PAUSE)
