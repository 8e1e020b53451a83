"""WARC archives: records written through Spark's text sink, read back by boundary-chain verification.

Writing. A record's text ends with two line ends, which is the line separator of the sink, so
each part file is one valid uncompressed archive. Of pages with equal payloads the one with the smallest
id is a response record; the others are revisit records, whose block keeps only the HTTP header.

Reading. The archives are read in splits, cut at every occurrence of the record magic, also inside
payloads. A task knows the offset of each piece within its split; sums over the splits of a file
make offsets of the file. Every piece whose header parses is a candidate record with a successor:
the offset its declared length leads to. Only what can be reached from the start of the file is a
record: tasks first follow successors inside their split, then pointer jumping doubles the distance
each round over the splits, and one walk per split marks what the chain enters. A magic inside a
payload starts a candidate that the chain never visits. Payload bytes are digested where they are
read; only records that hold a magic are put together in a second pass, one group a record.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str | None, url: str | None, payload: str, refers_to: str | None, revisit: bool) -> str:
    """Text of one record without the final separator."""
    raw = payload.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}\r\n\r\n"
    lines = [
        MAGIC.decode().strip(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id if page_id is not None else ''}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Payload-Digest: sha1:{digest(raw)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    block = http if revisit else http + payload
    return "\r\n".join([*lines, f"Content-Length: {len(block.encode())}", "", block])


def plan_records(pages: DataFrame, scratch: Scratch, least_bytes: int) -> DataFrame:
    """The pages with `first_id`: the smallest id with the same payload, where more than one has it.

    Only digests are grouped. The groups of more than one page are written first, so the join with
    the wide rows sends them along if they are few, and is a sort-merge join with split hot keys if not.
    """
    keyed = pages.withColumn("payload", F.coalesce("html", F.lit(""))).withColumn(
        "sha1", F.sha1(F.col("payload").cast("binary"))
    )
    size = F.octet_length("payload")
    groups = (
        keyed.where(size >= least_bytes)
        .groupBy("sha1", size.alias("size"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    groups = scratch.keep(groups, "groups")
    return keyed.join(groups, (keyed["sha1"] == groups["sha1"]) & (size == groups["size"]), "left").select(
        keyed["page_id"], "url", "payload", "first_id"
    )


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """One record a row. A null payload is empty; a null url is empty; control characters in it are escaped.

    Payloads under least_bytes are never revisits. All rows with the smallest id of their payload are
    responses, so repeated rows of it are too; a row with a null id is a revisit if a row with an id
    has its payload.
    """
    scratch = Scratch(pages.sparkSession, "warc-plan")
    plain = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    planned = plan_records(plain, scratch, least_bytes).select(
        F.col("page_id").cast("string"),
        "url",
        "payload",
        F.col("first_id").cast("string"),
        (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([record(*row) for row in rows], pa.string())], ["value"])

    planned.mapInArrow(build, "value string").write.option("lineSep", END.decode()).text(path)


# ---------------------------------------------------------------- reading


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics, in file order within each split: (path, split, value)."""
    return (
        spark.read.option("lineSep", MAGIC.decode())
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.col("value").cast("binary").alias("value"),
        )
    )


class _Offsets:
    """Offset of each piece behind the first one its split reads."""

    def __init__(self):
        self.split, self.at = None, 0

    def next(self, split: tuple, size: int) -> int:
        if split != self.split:
            self.split, self.at = split, 0
        at = self.at
        self.at += size + len(MAGIC)
        return at


def _headers(block: bytes) -> dict[bytes, bytes]:
    pairs = (line.split(b":", 1) for line in block.split(b"\r\n"))
    return {p[0].strip().lower(): p[1].strip() for p in pairs if len(p) == 2}


def _urn(value: bytes | None) -> str | None:
    found = re.fullmatch(rb"<urn:page:(.+)>", value or b"")
    return found[1].decode() if found else None


def parse(value: bytes) -> dict | None:
    """Header of a candidate record: its fields, the header's size and the declared length."""
    head = value.find(END)
    if head < 0:
        return None
    fields = _headers(value[:head])
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields or b"warc-record-id" not in fields:
        return None
    return {
        "head": head + len(END),
        "length": int(length),
        "record_type": fields[b"warc-type"].decode(errors="replace"),
        "record_id": _urn(fields[b"warc-record-id"]),
        "refers_to": _urn(fields.get(b"warc-refers-to")),
        "told": fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode(errors="replace"),
    }


def payload_of(fields: dict, value: bytes) -> dict:
    """Size and digest of the payload; a revisit's are those its headers tell."""
    block = value[fields["head"] : fields["head"] + fields["length"]]
    head = block.find(END)
    http, payload = (block[:head], block[head + len(END) :]) if head >= 0 else (b"", block)
    if fields["record_type"] == "revisit":
        size = _headers(http).get(b"content-length", b"0")
        return {"payload_bytes": int(size), "payload_digest": fields["told"]}
    return {"payload_bytes": len(payload), "payload_digest": digest(payload)}


_FIELDS = "record_type string, record_id string, refers_to string, payload_bytes bigint, payload_digest string"
PIECE = f"path string, split bigint, at bigint, size bigint, head bigint, length bigint, whole boolean, {_FIELDS}"


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Narrow rows: every piece's place, and for candidates their header, and their payload if it is whole."""
    offsets = _Offsets()
    empty = dict.fromkeys(("head", "length", "record_type", "record_id", "refers_to", "payload_bytes", "payload_digest"))
    schema = pa.schema(
        [("path", pa.string())]
        + [(n, pa.int64()) for n in ("split", "at", "size", "head", "length")]
        + [("whole", pa.bool_())]
        + [(n, pa.string()) for n in ("record_type", "record_id", "refers_to")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )
    for batch in batches:
        rows = []
        for path, split, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = offsets.next((path, split), len(value))
            # nothing at the start of a file follows a magic
            fields = parse(value) if split or at else None
            row = empty | {"path": path, "split": split, "at": at, "size": len(value), "whole": False}
            if fields:
                end = fields["head"] + fields["length"]
                row |= fields
                if value[end : end + len(END)] == END and len(value) == end + len(END):
                    row |= payload_of(fields, value) | {"whole": True}
            row.pop("told", None)
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema)


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """Follow successors inside one split: for each candidate the first offset outside it."""
    group = group.sort_values("off")
    end: dict[int, int] = {}
    for off, succ in zip(group["off"].iloc[::-1], group["succ"].iloc[::-1], strict=True):
        end[off] = end.get(succ, succ)
    return pd.DataFrame({"path": group["path"], "off": group["off"], "jump": group["off"].map(end)})


def _walk(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The records of one split that lie on the chain from its entry."""
    succ = dict(zip(group["off"], group["succ"], strict=True))
    on = set()
    for off in group.loc[group["entry"], "off"]:
        while off in succ and off not in on:
            on.add(off)
            off = succ[off]
    return group.loc[group["off"].isin(on), ["path", "off"]]


def chain(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """(path, off) of the records reachable from the start of their file, by pointer jumping."""
    steps = candidates.select("path", "split", "off", "succ")
    jumps = scratch.keep(
        steps.groupBy("path", "split").applyInPandas(_exits, "path string, off bigint, jump bigint"), "jump-0"
    )
    reached = scratch.keep(jumps.where("off = 0").select("path", "off"), "reached-0")
    turn, seen = 0, -1
    while (count := reached.count()) != seen:
        seen = count
        turn += 1
        targets = reached.join(jumps, ["path", "off"]).select("path", F.col("jump").alias("off"))
        reached = scratch.keep(reached.union(targets).distinct(), f"reached-{turn}")
        onward = jumps.select("path", F.col("off").alias("jump"), F.col("jump").alias("further"))
        jumps = scratch.keep(
            jumps.join(onward, ["path", "jump"], "left").select("path", "off", F.coalesce("further", "jump").alias("jump")),
            f"jump-{turn}",
        )
        scratch.drop(f"reached-{turn - 1}")
        scratch.drop(f"jump-{turn - 1}")
    entries = reached.withColumn("entry", F.lit(True))
    marked = steps.join(entries, ["path", "off"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return marked.groupBy("path", "split").applyInPandas(_walk, "path string, off bigint")


def _join_pieces(spark: SparkSession, path: str, broken: DataFrame, bases: DataFrame) -> DataFrame:
    """Records that hold a magic: their pieces in order, one group a record."""
    extents = (
        broken.select("path", "off", "succ")
        .join(bases, "path")
        .where((F.col("base") < F.col("succ")) & (F.col("base") + F.col("consumed") > F.col("off")))
        .select("path", "split", "base", "off", "succ")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = _Offsets()
        for batch in batches:
            at = [
                offsets.next((p, s), len(v)) for p, s, v in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], ["path", "split", "value", "at"])

    placed = pieces(spark, path).mapInArrow(place, "path string, split bigint, value binary, at bigint")
    parts = placed.join(extents, ["path", "split"]).withColumn("start", F.col("base") + F.col("at"))
    parts = parts.where((F.col("start") > F.col("off")) & (F.col("start") < F.col("succ"))).select(
        "path", "off", "start", "value"
    )

    def assemble(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        value = MAGIC.join(group.sort_values("start")["value"])
        fields = parse(value)
        fields |= payload_of(fields, value)
        return pd.DataFrame([{"path": key[0], "off": key[1]} | {k: fields[k] for k in names}])

    names = ["record_type", "record_id", "refers_to", "payload_bytes", "payload_digest"]
    return parts.groupBy("path", "off").applyInPandas(assemble, f"path string, off bigint, {_FIELDS}")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, off, record_type, record_id, refers_to, payload_bytes, payload_digest) of every record.

    Ids are texts, null where the archive has none. What the chain from the start of a file does not
    reach is not a record; a file that does not start with a record has none.
    """
    scratch = Scratch(spark, "warc-read")
    found = scratch.keep(pieces(spark, path).mapInArrow(scan, PIECE), "pieces")
    per_split = found.groupBy("path", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("consumed"))
    order = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)  # a row a split
    bases = scratch.keep(
        per_split.withColumn("base", F.coalesce(F.sum("consumed").over(order), F.lit(0))), "splits"
    )
    off = F.col("base") + F.col("at") - len(MAGIC)
    candidates = (
        found.where(F.col("head").isNotNull())
        .join(bases, ["path", "split"])
        .withColumn("off", off)
        .withColumn("succ", off + len(MAGIC) + F.col("head") + F.col("length") + len(END))
    )
    candidates = scratch.keep(candidates, "candidates")
    records = scratch.keep(candidates.join(chain(candidates, scratch), ["path", "off"]), "records")
    columns = ["path", "off", "record_type", "record_id", "refers_to", "payload_bytes", "payload_digest"]
    whole = records.where("whole").select(*columns)
    broken = records.where("NOT whole")
    if broken.isEmpty():
        return whole
    return whole.union(_join_pieces(spark, path, broken, bases).select(*columns))


def round_trip(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to as read from the pages' archives."""
    spark = pages.sparkSession
    path = f"{Scratch(spark, 'warc').root}/archives"
    write_archives(pages, path, least_bytes, id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType
    return read_archives(spark, path).select(
        F.col("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
