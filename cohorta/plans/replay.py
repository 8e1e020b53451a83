"""Ingestion of logs that grow: each state of a log is written whole, a ledger says which state counts.

`ingest_events` replaces the months a log holds, so two logs that share a month take each other's rows,
and a stream sees a file only once. Here rows lie below ``log=<path>/state=<files>``. A log that has
changed since its last entry is written again as a new state, and one commit in the ledger makes it the one
that counts. A job that dies before the commit leaves files nobody reads; repeated, it replaces
them. Readers see the old state or the new one, never both.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.contracts import UseCase
from cohorta.functions.scalars import time_between, utc_naive
from cohorta.sources.commits import numbered_commit
from cohorta.sources.events import CORRUPT, event_schema, flatten_features, parse_event_lines
from cohorta.sources.monthly import MONTH, YEAR, month_predicate, with_month

LEDGER = (
    "entry bigint, log string, state string, path string, files bigint, bytes bigint, "
    "events bigint, malformed bigint, months array<string>"
)
LOG, STATE, BROKEN = "log", "state", "broken"


def _folder(dataset: str, part: str) -> str:
    return f"{dataset.rstrip('/')}/{part}"


def ledger(spark: SparkSession, dataset: str) -> DataFrame:
    """Every state that was ever committed; empty before the first."""
    try:
        return spark.read.schema(LEDGER).json(_folder(dataset, "ledger"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def current_states(entries: DataFrame) -> DataFrame:
    """The last entry of each log."""
    whole = F.struct(*entries.columns)
    return entries.groupBy(LOG).agg(F.max_by(whole, "entry").alias("_e")).select("_e.*")


def log_state(spark: SparkSession, log: str) -> dict | None:
    """State of a log, a file or a folder of files, from names, lengths and times alone; None if it is absent."""
    try:
        files = spark.read.format("binaryFile").load(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    about = files.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    mark = F.pmod(F.xxhash64("file_path", "file_size", "file_modification_time"), F.lit(2**31))
    row = about.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(mark), F.lit(0)).alias("mark"),
    ).first()
    return {STATE: f"{row['files']}-{row['bytes']}-{row['mark']}", "files": row["files"], "bytes": row["bytes"]}


def ingest_log(spark: SparkSession, log: str, dataset: str, use_case: UseCase) -> bool:
    """Bring a log's present state into the dataset; false if it is absent or already there.

    Malformed lines, unreadable times included, are kept beside the events of the same state. A log
    that is gone keeps its last state. Events without a time are kept in no month.
    """
    path, time = log.rstrip("/"), use_case.time_column
    key = hashlib.md5(path.encode()).hexdigest()
    found = log_state(spark, path)
    if found is None:
        return False
    known = current_states(ledger(spark, dataset).where(F.col(LOG) == key)).first()
    if known is not None and known[STATE] == found[STATE]:
        return False
    records = parse_event_lines(spark.read.text(path), event_schema(use_case), time)
    flat = flatten_features(records.withColumn(BROKEN, F.col(CORRUPT).isNotNull()))
    kept = F.when(~F.col(BROKEN), utc_naive(F.col(time)))
    rows = with_month(flat.withColumn(time, kept), time).withColumns({LOG: F.lit(key), STATE: F.lit(found[STATE])})
    writer = rows.hint("rebalance", F.col(BROKEN), F.col(YEAR), F.col(MONTH)).write
    writer.partitionBy(LOG, STATE, BROKEN, YEAR, MONTH).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(_folder(dataset, "rows"))
    counted = _count(spark, dataset, use_case, key, found[STATE])

    def last() -> tuple[int, None]:
        return ledger(spark, dataset).agg(F.max("entry")).first()[0] or 0, None

    def record(entry: int, _) -> DataFrame:
        row = (entry, key, found[STATE], path, found["files"], found["bytes"], *counted)
        return spark.createDataFrame([row], LEDGER)

    numbered_commit(spark, lambda n: f"{_folder(dataset, 'ledger')}/{n:012d}.json", last, record)
    return True


def _rows(spark: SparkSession, dataset: str, use_case: UseCase) -> DataFrame:
    """All written rows, of states that count and others; empty where nothing was written."""
    empty = flatten_features(spark.createDataFrame([], event_schema(use_case)))
    time = F.col(use_case.time_column).cast("timestamp_ntz")
    schema = empty.withColumns({
        use_case.time_column: time, LOG: F.lit(""), STATE: F.lit(""), BROKEN: F.lit(True),
        YEAR: F.lit(0), MONTH: F.lit(0),
    })
    try:
        return spark.read.schema(schema.schema).parquet(_folder(dataset, "rows"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return schema


def _count(spark: SparkSession, dataset: str, use_case: UseCase, key: str, state: str) -> tuple[int, int, list[str]]:
    """(events, malformed lines, months) of a written state, from footers and partition names."""
    own = _rows(spark, dataset, use_case).where((F.col(LOG) == key) & (F.col(STATE) == state))
    month = F.when(~F.col(BROKEN), F.format_string("%04d-%02d", YEAR, MONTH))
    named = F.when(F.col(YEAR).isNotNull(), month)
    row = own.agg(
        F.count_if(~F.col(BROKEN)).alias("events"),
        F.count_if(BROKEN).alias("malformed"),
        F.array_sort(F.collect_set(named)).alias("months"),
    ).first()
    return row["events"], row["malformed"], row["months"]


def _live(spark: SparkSession, dataset: str, use_case: UseCase) -> DataFrame:
    """Rows of the states that count; the join prunes the folders of all others."""
    # entries count from 1; folders are pruned at run time only where the other side has a condition
    states = current_states(ledger(spark, dataset)).where("entry > 0").select(LOG, STATE)
    return _rows(spark, dataset, use_case).join(states, [LOG, STATE], "left_semi")


def read_ingested(spark: SparkSession, dataset: str, use_case: UseCase, start=None, end=None) -> DataFrame:
    """Events of all logs, each once, optionally between two inclusive bounds (months outside are not read)."""
    if (start is None) != (end is None):
        raise ValueError("Give both bounds or none.")
    rows = _live(spark, dataset, use_case).where(~F.col(BROKEN))
    if start is not None:
        rows = rows.where(month_predicate(start, end)).where(time_between(F.col(use_case.time_column), start, end))
    return rows.drop(CORRUPT, LOG, STATE, BROKEN)


def read_malformed(spark: SparkSession, dataset: str, use_case: UseCase) -> DataFrame:
    """(log, line) of every malformed line of the states that count, each as often as the log holds it."""
    paths = current_states(ledger(spark, dataset)).select(LOG, "path")
    broken = _live(spark, dataset, use_case).where(BROKEN).select(LOG, F.col(CORRUPT).alias("line"))
    return broken.join(paths, LOG).select(F.col("path").alias("log"), "line")


def drop_superseded(spark: SparkSession, dataset: str) -> int:
    """Delete the files of states that no longer count and return how many states that were.

    Run it when no reader holds an older ledger.
    """
    entries = ledger(spark, dataset)
    old = entries.select(LOG, STATE).distinct().join(current_states(entries).select(LOG, STATE), [LOG, STATE], "left_anti")
    dropped = 0
    for row in old.toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(dataset, 'rows')}/{LOG}={row[LOG]}/{STATE}={row[STATE]}")
        dropped += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return dropped
