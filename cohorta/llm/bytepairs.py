"""Byte-level BPE as recursive queries: DuckDB inside each partition, on token-position rows.

The split pattern cuts a text into words. A partition's distinct words become rows (word, position,
token), one a byte. A recursive query joins neighbours with the merge table, finds each word's
smallest rank and contracts its leftmost pair of that rank, until no word has a pair left. Decoding
is the aggregation of the tokens' bytes, ordered by a query.

A word of up to `SHORT_BYTES` bytes loses one row a round. A longer one (a run of a letter, a page of
white space) would take as many rounds as it has bytes, so there the pairs of the smallest rank
further right are contracted in the same round if that is provably the same result: contracting a
pair can only make a smaller rank possible for tokens marked `last_first` in the merge table, and for
those only the leftmost pair is taken. A round's rows are kept until the query ends, so these queries
run at most `ROUNDS` rounds and the next continues from the last state: memory stays proportional
to the words. Words met before by the same worker are looked up in a bounded store;
when it is full, those met in one block of texts only are forgotten.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from cohorta.llm.common import schema_with, without

SHORT_BYTES = 48
ROUNDS = 24
BYTES_AT_ONCE = 1 << 17  # of words in one query
STORE = 200_000  # words a worker remembers between blocks of texts
RESULT = "ids array<int>, decoded binary"
DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

MERGES = """
CREATE TABLE merge AS
WITH cut AS (
  SELECT t.rank AS merged, l.rank AS l, r.rank AS r
  FROM token t, unnest(range(1, strlen(t.hex) // 2)) AS c(k)
  JOIN token l ON l.hex = substr(t.hex, 1, 2 * k) JOIN token r ON r.hex = substr(t.hex, 2 * k + 1)
)
-- a token that is part of one with a smaller rank: contracting it can bring that rank up
SELECT cut.*, l::BIGINT * 4294967296 + r AS both_parts, merged IN (SELECT l FROM cut AS c WHERE c.merged < c.l UNION SELECT r FROM cut AS c WHERE c.merged < c.r)
         AS last_first
FROM cut
"""

# The merged token takes the place of its right part; each row knows its right neighbour.
CONTRACT_SHORT = """
WITH RECURSIVE state(round, word, pos, next_pos, tok, next_tok) AS (
  SELECT 0, word, pos, pos + 1, tok, next_tok FROM start
  UNION ALL
  (
    WITH best AS (
      SELECT word, min(merged::BIGINT * 65536 + pos) AS code, arg_min(next_pos, merged::BIGINT * 65536 + pos) AS right_pos
      FROM state JOIN merge ON both_parts = tok::BIGINT * 4294967296 + next_tok GROUP BY word
    )
    SELECT round + 1, word, pos,
           CASE WHEN next_pos = code % 65536 THEN right_pos ELSE next_pos END,
           CASE WHEN pos = right_pos THEN code // 65536 ELSE tok END,
           CASE WHEN next_pos = code % 65536 THEN code // 65536 ELSE next_tok END
    FROM state JOIN best USING (word) WHERE pos <> code % 65536
  )
)
SELECT word, pos, tok::INTEGER AS tok
FROM state JOIN (SELECT word, max(round) AS round FROM state GROUP BY word) USING (word, round)
"""

CONTRACT_LONG = """
WITH RECURSIVE state(round, word, pos, tok) AS (
  SELECT 0, word, pos, tok FROM start
  UNION ALL
  (
    WITH pair AS (
      SELECT s.*, m.merged, m.last_first
      FROM (SELECT *, lead(tok) OVER w AS next_tok FROM state WINDOW w AS (PARTITION BY word ORDER BY pos)) AS s
      LEFT JOIN merge AS m ON m.l = s.tok AND m.r = s.next_tok
    ),
    least AS (
      SELECT *, min(merged) OVER (PARTITION BY word) AS smallest FROM pair
    ),
    chance AS (
      SELECT *, coalesce(merged = smallest, false) AS here,
             row_number() OVER (PARTITION BY word ORDER BY pos) AS n
      FROM least WHERE smallest IS NOT NULL
    ),
    -- pairs of the smallest rank side by side overlap: every other one counts, from the left
    island AS (
      SELECT *, max(CASE WHEN here THEN 0 ELSE n END) OVER w AS gap, count(CASE WHEN here THEN 1 END) OVER w AS nth
      FROM chance WINDOW w AS (PARTITION BY word ORDER BY pos)
    ),
    taken AS (
      SELECT *, here AND CASE WHEN last_first THEN nth = 1 ELSE (n - gap) % 2 = 1 END AS take FROM island
    ),
    marked AS (
      SELECT *, lag(take, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone FROM taken
    )
    SELECT round + 1, word, pos, CASE WHEN take THEN merged ELSE tok END
    FROM marked WHERE NOT gone AND round < $rounds
  )
)
SELECT round, word, pos, tok FROM state
QUALIFY round = max(round) OVER (PARTITION BY word)
"""

DECODE = """
SELECT word, name, bytes FROM result JOIN token ON token.rank = result.tok ORDER BY word, pos
"""


class Encoder:
    """Token ids and decoded bytes of words, by queries over a database in this process's memory."""

    def __init__(self, ranks_path: str, pattern: str):
        self.split = regex.compile(pattern)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        token = pa.table({
            "hex": [t.hex() for t in ranks],
            "rank": pa.array(list(ranks.values()), pa.int32()),
            "name": [str(r) for r in ranks.values()],
            "bytes": pa.array(list(ranks), pa.binary()),
        })
        self.db = None
        self.tables = {"token": token}
        self._open()
        self.db.execute(MERGES)
        self.tables["merge"] = self.db.sql("SELECT * FROM merge").to_arrow_table()
        self.single = np.full(256, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
        self.ids: dict[str, str] = {}  # of the words in the store: ids as text, joined by a space
        self.decoded: dict[str, bytes] = {}
        self.again: set[str] = set()  # words of the store that a later block of texts had, too

    def _open(self) -> None:
        if self.db is None:
            self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
            for name, table in self.tables.items():
                self.db.register("given", table)
                self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                self.db.unregister("given")

    def rest(self) -> None:
        """Give the database's memory back until it is asked again; the words it has met are kept."""
        if self.db is not None:
            self.db.close()
            self.db = None

    def _rows(self, words: list[bytes]) -> dict[str, np.ndarray]:
        sizes = np.array([len(w) for w in words])
        last = np.cumsum(sizes) - 1
        tok = self.single[np.frombuffer(b"".join(words), np.uint8)]
        next_tok = np.append(tok[1:], -1)
        next_tok[last] = -1
        return {
            "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
            "pos": (np.arange(len(tok)) - np.repeat(last - sizes + 1, sizes)).astype(np.int32),
            "tok": tok,
            "next_tok": next_tok.astype(np.int32),
        }

    def _ask(self, query: str, name: str, table: pa.Table, **parameters) -> pa.Table:
        self._open()
        self.db.register(name, table)
        answer = self.db.sql(query, params=parameters).to_arrow_table() if parameters else self.db.sql(query).to_arrow_table()
        self.db.unregister(name)
        return answer

    def _contract(self, words: list[str], short: bool) -> None:
        """Store ids and bytes of the words."""
        state = pa.table(self._rows([w.encode() for w in words]))
        if short:
            result = self._ask(CONTRACT_SHORT, "start", state)
        else:
            done = []
            while state.num_rows:
                after = self._ask(CONTRACT_LONG, "start", state, rounds=ROUNDS)
                # the words that were still being contracted in the last round go on
                again = pc.equal(after["round"], ROUNDS)
                done.append(after.filter(pc.invert(again)).select(["word", "pos", "tok"]))
                state = after.filter(again).select(["word", "pos", "tok"])
            result = pa.concat_tables(done)
        answer = self._ask(DECODE, "result", result).combine_chunks()
        word = answer["word"].to_numpy()
        first = np.flatnonzero(np.diff(word, prepend=-1))
        met = [words[i] for i in word[first].tolist()]
        bounds = pa.array(np.append(first, len(word)).astype(np.int32))
        for store, column, between in ((self.ids, "name", " "), (self.decoded, "bytes", b"")):
            lists = pa.ListArray.from_arrays(bounds, answer[column].chunk(0))
            store.update(zip(met, pc.binary_join(lists, between).to_numpy(zero_copy_only=False), strict=True))

    def _forget(self, words: set[str]) -> None:
        """Keep of a full store what was met in more than one block; if that is most of it, what is needed now."""
        kept = self.again if len(self.again) <= STORE // 2 else words & self.ids.keys()
        self.ids = {w: self.ids[w] for w in kept}
        self.decoded = {w: self.decoded[w] for w in kept}
        self.again = set()

    def learn(self, words: set[str]) -> None:
        """Contract the words that are not in the store, some at a time."""
        self.again |= words & self.ids.keys()
        if len(self.ids) > STORE:
            self._forget(words)
        new = sorted(words - self.ids.keys())
        coded = [w.encode() for w in new]
        for short in (True, False):
            block, size = [], 0
            for word, data in zip(new, coded, strict=True):
                if (len(data) <= SHORT_BYTES) != short:
                    continue
                block.append(word)
                size += len(data)
                if size >= BYTES_AT_ONCE:
                    self._contract(block, short)
                    block, size = [], 0
            if block:
                self._contract(block, short)

    def _cut(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, all of them in the store."""
        cut = [self.split.findall(t) if t else [] for t in texts]
        self.learn(set().union(*cut) if cut else set())
        return cut

    def encode(self, texts: list[str | None]) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        """Per text the ids, the ids as text and the decoded bytes of each of its words."""
        for words in self._cut(texts):
            yield [(tuple(map(int, self.ids[w].split())), self.ids[w], self.decoded[w]) for w in words]

    def encode_whole(self, texts: list[str | None]) -> Iterator[tuple[int, str, bytes]]:
        """Per text the number of ids, the ids as text and the decoded bytes."""
        for words in self._cut(texts):
            ids = " ".join(map(self.ids.__getitem__, words))
            yield ids.count(" ") + 1 if words else 0, ids, b"".join(map(self.decoded.__getitem__, words))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder a worker process: it serves all its tasks."""
    if (ranks_path, pattern) not in _ENCODERS:
        _ENCODERS[ranks_path, pattern] = Encoder(ranks_path, pattern)
    return _ENCODERS[ranks_path, pattern]


ROWS = 1024  # texts split at a time


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows with `ids` and the bytes they decode to.

    Null and empty texts have no ids; repeated rows are encoded alike; special tokens are ordinary
    text. The vocabulary file must be at ranks_path on every executor. Columns of the result's names
    that the frame has already are replaced.
    """
    docs = without(docs, ("ids", "decoded"), text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                n, texts, decoded = zip(*encoder.encode_whole(batch.column(text_col).to_pylist()), strict=True)
                ends = np.cumsum((0, *n), dtype=np.int32)
                flat = np.fromstring(" ".join(filter(None, texts)), np.int32, sep=" ")
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                decoded = pa.array(decoded, pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, decoded], [*batch.schema.names, "ids", "decoded"])
        encoder.rest()

    return docs.mapInArrow(run, schema_with(docs, RESULT))


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """As `encode`, but only the number of ids and digests of ids (joined by a space) and decoded bytes."""
    docs = without(docs, ("n_tokens", "ids_sha256", "decoded_sha256"), text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                n, ids, decoded = [], [], []
                for length, text, data in encoder.encode_whole(batch.column(text_col).to_pylist()):
                    n.append(length)
                    ids.append(hashlib.sha256(text.encode()).hexdigest())
                    decoded.append(hashlib.sha256(data).hexdigest())
                more = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *more], [*batch.schema.names, "n_tokens", "ids_sha256", "decoded_sha256"]
                )
        encoder.rest()

    return docs.mapInArrow(run, schema_with(docs, DIGEST))
