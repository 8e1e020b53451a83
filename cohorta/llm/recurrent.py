"""Language-model scoring with a gated recurrent network, trained and applied in numpy inside tasks.

Vocabulary. Spark counts the tokens of all training documents. The commonest words (`SHORTLIST`) are
outputs of the network in classes of `MEMBERS` words; every other word belongs to one of `SHAPES`
shape classes by its last two bytes. The output is factored: a softmax over classes, then either a softmax
over the class's words or, in a shape class, smoothed corpus counts. So the model is a distribution
over all words, and its rare-word part grows with the corpus.

Training. Truncated backpropagation: lanes of documents run through windows of `WINDOW` tokens, the
state is carried from window to window and cleared where a document begins. Each partition trains its
own copy on its share of the training documents (one in `EVERY` a round, by a hash of the id), and
the copies are averaged by tokens in a tree; there are `ROUNDS` rounds.

Scoring. Whole documents run through with the state carried, many lanes at once. Counts of words
with at least 1 / `HEAVY` of all training tokens are sent to the tasks (there are at most `HEAVY` of
them); all other words leave as rows and meet their counts in a join, in which no word of the
training text is hot.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import Scratch

SHORTLIST, MEMBERS, SHAPES, HIDDEN = 2016, 48, 64, 32
WINDOW, LANES, RATE = 24, 160, 0.012
UPDATES = 120  # a small share takes fewer lanes, so that it still makes about so many updates
EVERY = 8  # shares of the training documents, one a round
HEAVY = 1 << 19
FLUSH = 400_000  # distinct words a counting task holds
CHUNK = 3 << 20  # tokens scored together
TRAIN_CHUNK = 1 << 20
SCORE_LANES, SCORE_STATES = 512, 1 << 16
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words; ASCII white space is what bytes.split takes apart."""
    return (text or b"").translate(_FOLD).split()


def shape(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHAPES


# ---------------------------------------------------------------- counts


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, c) over the documents; tasks add up what they can hold before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "c"]
            )

        for batch in batches:
            for value in batch.column(0):
                found.update(words_of(value.as_py()))
                if len(found) > FLUSH:
                    yield out()
                    found.clear()
        yield out()

    partial = docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "word binary, c bigint")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks need to know of the counts: bounded by HEAVY words."""

    log_counts: dict[bytes, float]  # heavy words: log10(c + 0.5)
    numbers: dict[bytes, int]  # shortlist words
    counts: np.ndarray  # of the shortlist words
    shape_tokens: np.ndarray
    shape_kinds: np.ndarray
    documents: int
    tokens: int
    kinds: int

    @property
    def groups(self) -> int:
        return -(-max(1, len(self.numbers)) // MEMBERS)

    @property
    def end(self) -> int:
        return self.groups * MEMBERS + SHAPES

    def base_norm(self) -> float:
        return float(np.log10(self.tokens + 0.5 * (self.kinds + 1)))

    def shape_norms(self) -> np.ndarray:
        return np.log10(self.shape_tokens + 0.5 * (self.shape_kinds + 1))


def vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    words, kinds = total["n"] or 0, total["v"] or 0
    tokens = words + documents
    heavy = counts.where(F.col("c") * HEAVY >= tokens).collect()  # at most HEAVY rows
    heavy.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    short = heavy[:SHORTLIST]
    rare_tokens, rare_kinds = np.zeros(SHAPES), np.zeros(SHAPES)
    by_shape = counts.groupBy((F.crc32(F.expr("substring(word, -2, 2)")) % SHAPES).cast("int").alias("s"))
    for row in by_shape.agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        rare_tokens[row["s"]], rare_kinds[row["s"]] = row["n"], row["v"]
    for row in short:
        s = shape(bytes(row["word"]))
        rare_tokens[s] -= row["c"]
        rare_kinds[s] -= 1
    return Vocabulary(
        {bytes(r["word"]): float(np.log10(r["c"] + 0.5)) for r in heavy},
        {bytes(r["word"]): i for i, r in enumerate(short)},
        np.array([r["c"] for r in short], float),
        rare_tokens,
        rare_kinds,
        documents,
        tokens,
        kinds + (documents > 0),
    )


# ---------------------------------------------------------------- network


def first_weights(vocab: Vocabulary, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights; the output biases make the untrained model the unigram model."""
    rng = np.random.default_rng(seed)
    groups, h = vocab.groups, HIDDEN
    classes = groups + SHAPES + 1
    members = np.full(groups * MEMBERS, -1e9)
    members[: len(vocab.counts)] = np.log(vocab.counts + 0.5)
    members = members.reshape(groups, MEMBERS)
    if not len(vocab.counts):
        members[:, 0] = 0
    mass = np.zeros(groups * MEMBERS)
    mass[: len(vocab.counts)] = vocab.counts
    mass = np.concatenate((mass.reshape(groups, MEMBERS).sum(axis=1), vocab.shape_tokens, [vocab.documents])) + 0.5
    top = members.max(axis=1, keepdims=True)
    norm = top + np.log(np.exp(members - top).sum(axis=1, keepdims=True))
    weights = {
        "x": rng.normal(0, 0.3, (vocab.end + 1, 3 * h)),
        "u": rng.normal(0, h**-0.5, (h, 3 * h)),
        "n": np.zeros(h),
        "wc": rng.normal(0, 0.05, (h, classes)),
        "bc": np.log(mass / mass.sum()),
        "ww": rng.normal(0, 0.05, (groups, h, MEMBERS)),
        "bw": np.maximum(members - norm, -1e9),
    }
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; x is a scratch array."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _step(w: dict, rows: np.ndarray, state: np.ndarray):
    h = HIDDEN
    a = state @ w["u"]
    gates = _sigmoid(rows[:, : 2 * h] + a[:, : 2 * h])
    z, r = gates[:, :h], gates[:, h:]
    inner = a[:, 2 * h :] + w["n"]
    n = r * inner
    n += rows[:, 2 * h :]
    np.tanh(n, out=n)
    after = state - n
    after *= z
    after += n
    return after, z, r, n, inner


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _log_sums(logits: np.ndarray) -> np.ndarray:
    """log of the summed exponentials of each row; the rows are overwritten."""
    if logits.max() > 60:  # only then can single precision overflow
        top = logits.max(axis=1, keepdims=True)
        logits -= top
        return np.log(np.exp(logits, out=logits).sum(axis=1)) + top[:, 0]
    return np.log(np.exp(logits, out=logits).sum(axis=1))


def _by_class(classes: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers of each class of shortlist words."""
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(groups + 1))
    for g in range(groups):
        if edges[g] < edges[g + 1]:
            yield g, order[edges[g] : edges[g + 1]]


def _targets(symbols: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Class and place in the class (shortlist only) of symbols."""
    short = groups * MEMBERS
    classes = np.where(symbols < short, symbols // MEMBERS, symbols - short + groups)
    return classes, symbols % MEMBERS


def train_window(w: dict, state: np.ndarray, inputs: np.ndarray, targets: np.ndarray, live: np.ndarray, fresh: np.ndarray):
    """One window forwards and backwards: gradients (mean over live tokens) and the state behind it."""
    steps, lanes = inputs.shape
    h, groups = HIDDEN, len(w["ww"])
    kept = []
    states = np.empty((steps, lanes, h), np.float32)
    for t in range(steps):
        state = np.where(fresh[t][:, None], np.float32(0), state)
        after, *gates = _step(w, w["x"][inputs[t]], state)
        kept.append((state, *gates))
        states[t] = state = after
    flat = states.reshape(-1, h)
    scale = (live.ravel() / max(1, live.sum())).astype(np.float32)[:, None]
    classes, places = _targets(targets.ravel(), groups)
    p = _softmax(flat @ w["wc"] + w["bc"])
    p[np.arange(len(p)), classes] -= 1
    p *= scale
    grad = {"wc": flat.T @ p, "bc": p.sum(axis=0), "ww": np.zeros_like(w["ww"]), "bw": np.zeros_like(w["bw"])}
    back = p @ w["wc"].T
    for g, rows in _by_class(classes, groups):
        q = _softmax(flat[rows] @ w["ww"][g] + w["bw"][g])
        q[np.arange(len(rows)), places[rows]] -= 1
        q *= scale[rows]
        grad["ww"][g] = flat[rows].T @ q
        grad["bw"][g] = q.sum(axis=0)
        back[rows] += q @ w["ww"][g].T
    back = back.reshape(steps, lanes, h)
    grad["u"], grad["n"] = np.zeros_like(w["u"]), np.zeros_like(w["n"])
    into = np.empty((steps, lanes, 3 * h), np.float32)
    carried = np.zeros((lanes, h), np.float32)
    for t in range(steps - 1, -1, -1):
        before, z, r, n, inner = kept[t]
        d = back[t] + carried
        dn = d * (1 - z) * (1 - n * n)
        into[t, :, :h] = d * (before - n) * z * (1 - z)
        into[t, :, h : 2 * h] = dn * inner * r * (1 - r)
        into[t, :, 2 * h :] = dn
        da = into[t].copy()
        da[:, 2 * h :] *= r
        grad["u"] += before.T @ da
        grad["n"] += da[:, 2 * h :].sum(axis=0)
        carried = (d * z + da @ w["u"].T) * ~fresh[t][:, None]
    order = np.argsort(inputs.ravel(), kind="stable")
    seen, first = np.unique(inputs.ravel()[order], return_index=True)
    grad["x"] = np.zeros_like(w["x"])
    grad["x"][seen] = np.add.reduceat(into.reshape(-1, 3 * h)[order], first)
    return grad, state


class Adam:
    def __init__(self, w: dict, rate: float):
        self.w, self.rate, self.turn = w, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in w.items()}
        self.v = {k: np.zeros_like(v) for k, v in w.items()}

    def update(self, grad: dict) -> None:
        self.turn += 1
        size = float(np.sqrt(sum(np.vdot(g, g) for g in grad.values())))
        shrink = min(1.0, 1.0 / max(size, 1e-9))
        fix = self.rate * np.sqrt(1 - 0.999**self.turn) / (1 - 0.9**self.turn)
        for k, g in grad.items():
            g = g * np.float32(shrink)
            self.m[k] += np.float32(0.1) * (g - self.m[k])
            self.v[k] += np.float32(0.001) * (g * g - self.v[k])
            self.w[k] -= np.float32(fix) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-6))


def to_lanes(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first to the shortest lane; lanes by falling length."""
    heap = [(0, i) for i in range(lanes)]
    given: list[list[int]] = [[] for _ in range(lanes)]
    size = [0] * lanes
    for d in np.argsort(-lengths, kind="stable").tolist():
        load, lane = heapq.heappop(heap)
        given[lane].append(d)
        size[lane] = load + int(lengths[d])
        heapq.heappush(heap, (size[lane], lane))
    return [given[i] for i in sorted(range(lanes), key=lambda i: -size[i]) if given[i]]


def laid_out(docs: list[np.ndarray], lanes: int, end: int):
    """(inputs, targets, document, fresh) as steps by lanes, and the lanes' lengths; a document's first input is the end."""
    given = to_lanes(np.array([len(d) for d in docs]), lanes)
    sizes = np.array([sum(len(docs[i]) for i in lane) for lane in given])
    shape_ = (int(sizes.max()), len(given))
    inputs, targets = np.full(shape_, end, np.int32), np.full(shape_, end, np.int32)
    owner, fresh = np.zeros(shape_, np.int32), np.zeros(shape_, bool)
    for k, lane in enumerate(given):
        at = 0
        for i in lane:
            to = at + len(docs[i])
            targets[at:to, k] = docs[i]
            inputs[at + 1 : to, k] = docs[i][:-1]
            owner[at:to, k] = i
            fresh[at, k] = True
            at = to
    return inputs, targets, owner, fresh, sizes


def train_chunk(optimiser: Adam, docs: list[np.ndarray], end: int) -> int:
    tokens = sum(map(len, docs))
    lanes = int(min(LANES, max(4, tokens // (WINDOW * UPDATES))))
    inputs, targets, _, fresh, sizes = laid_out(docs, lanes, end)
    state = np.zeros((inputs.shape[1], HIDDEN), np.float32)
    for t in range(0, len(inputs), WINDOW):
        part = slice(t, t + WINDOW)
        # lanes are in falling order of length: the ended ones are the last
        lanes_left = int((sizes > t).sum())
        live = np.arange(t, min(t + WINDOW, len(inputs)))[:, None] < sizes[None, :lanes_left]
        grad, after = train_window(
            optimiser.w, state[:lanes_left], inputs[part, :lanes_left], targets[part, :lanes_left], live, fresh[part, :lanes_left]
        )
        state = after
        optimiser.update(grad)
    return tokens


def score_chunk(w: dict, docs: list[np.ndarray], end: int) -> np.ndarray:
    """log10 probability of each document's classes and shortlist words, state carried to its end."""
    groups = len(w["ww"])
    inputs, targets, owner, fresh, sizes = laid_out(docs, SCORE_LANES, end)
    total = np.zeros(len(docs))
    state = np.zeros((inputs.shape[1], HIDDEN), np.float32)
    t = 0
    while t < len(inputs):
        lanes = int((sizes > t).sum())
        # few lanes are left where long documents end: then more steps make a block
        steps = min(max(1, SCORE_STATES // lanes), len(inputs) - t)
        state = state[:lanes]
        states = np.empty((steps, lanes, HIDDEN), np.float32)
        for s in range(steps):
            state = np.where(fresh[t + s, :lanes, None], np.float32(0), state)
            state = states[s] = _step(w, w["x"][inputs[t + s, :lanes]], state)[0]
        live = (np.arange(t, t + steps)[:, None] < sizes[None, :lanes]).ravel()
        flat = states.reshape(-1, HIDDEN)[live]
        classes, places = _targets(targets[t : t + steps, :lanes].ravel()[live], groups)
        logits = flat @ w["wc"]
        logits += w["bc"]
        score = logits[np.arange(len(logits)), classes].astype(float)
        score -= _log_sums(logits)
        for g, rows in _by_class(classes, groups):
            inner = flat[rows] @ w["ww"][g]
            inner += w["bw"][g]
            score[rows] += inner[np.arange(len(rows)), places[rows]]
            score[rows] -= _log_sums(inner)
        total += np.bincount(owner[t : t + steps, :lanes].ravel()[live], score, len(docs))
        t += steps
    return total / np.log(10)


# ---------------------------------------------------------------- jobs


def symbols_of(words: list[bytes], vocab: Vocabulary) -> np.ndarray:
    """Symbols of a text's words, then the end."""
    short = vocab.groups * MEMBERS
    get, numbers = vocab.numbers.get, []
    for word in words:
        number = get(word)
        numbers.append(short + zlib.crc32(word[-2:]) % SHAPES if number is None else number)
    numbers.append(vocab.end)
    return np.array(numbers, np.int32)


def _pack(w: dict) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def _unpack(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train(docs: DataFrame, vocab: Vocabulary, id_col: str, text_col: str) -> dict[str, np.ndarray]:
    """Weights after all rounds of local training and averaging."""
    sc = docs.sparkSession.sparkContext
    weights = first_weights(vocab)
    for turn in range(EVERY):
        share = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(EVERY)) == turn)
        shared = sc.broadcast((vocab, weights))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, start = shared.value
            optimiser = Adam({k: v.copy() for k, v in start.items()}, RATE)
            tokens, held, size = 0, [], 0
            for batch in batches:
                for value in batch.column(0):
                    held.append(symbols_of(words_of(value.as_py()), vocab))
                    size += len(held[-1])
                    if size >= TRAIN_CHUNK:
                        tokens += train_chunk(optimiser, held, vocab.end)
                        held, size = [], 0
            if held:
                tokens += train_chunk(optimiser, held, vocab.end)
            if tokens:
                flat = (_pack(optimiser.w).astype(np.float64) * tokens).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([float(tokens)]), pa.array([flat.tobytes()], pa.binary())], ["tokens", "weights"]
                )

        trained = share.select(F.col(text_col).cast("binary")).mapInArrow(run, "tokens double, weights binary")
        sums = trained.rdd.map(lambda r: (r[0], np.frombuffer(r[1], np.float32).astype(np.float64)))
        tokens, total = sums.treeAggregate(
            (0.0, 0.0), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1])
        )
        shared.unpersist()
        if tokens:
            weights = _unpack(total / tokens, weights)
    return weights


SCORED = "row bigint, n_tokens bigint, n_known bigint, heavy double, rare double, network double, tail array<binary>"


def _score_rows(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, weights: dict) -> Iterator[pa.RecordBatch]:
    norms, known_end, short = vocab.shape_norms().tolist(), int(vocab.documents > 0), vocab.groups * MEMBERS
    end_log = float(np.log10(vocab.documents + 0.5))
    # symbol, log of the smoothed count, and what of the score doesn't come from the network
    table = {}
    for word, log in vocab.log_counts.items():
        number, kind = vocab.numbers.get(word), shape(word)
        table[word] = (short + kind, log, log - norms[kind]) if number is None else (number, log, 0.0)
    rows: list[list] = []
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        network = score_chunk(weights, held, vocab.end)
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
        columns.insert(5, network)
        names = [part.split()[0] for part in SCORED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    size, get = 0, table.get
    for batch in batches:
        for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = words_of(value.as_py())
            heavy, rare, tail, symbols = end_log, 0.0, [], []
            for word in words:
                found = get(word)
                if found is None:
                    kind = zlib.crc32(word[-2:]) % SHAPES
                    tail.append(word)
                    rare -= norms[kind]
                    symbols.append(short + kind)
                else:
                    symbol, log, part = found
                    symbols.append(symbol)
                    heavy += log
                    rare += part
            symbols.append(vocab.end)
            held.append(np.array(symbols, np.int32))
            rows.append([row, len(symbols), len(words) - len(tail) + known_end, heavy, rare, tail])
            size += len(symbols)
            if size >= CHUNK:
                yield out()
                rows.clear()
                held.clear()
                size = 0
    if rows:
        yield out()


def score(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row; `learn` is the condition of the documents that are learned from.

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score (unigrams with 0.5 added to each
    count) and score, both log10 probabilities of the whole text and its end. Null and empty texts are one
    end token; without training documents all words are unknown; repeated rows count as often as
    they occur and are each scored.
    """
    scratch = Scratch(docs.sparkSession, "recurrent")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), learn.alias("learn"))
    known = plain.where("learn")
    counts = scratch.keep(count_words(known, "text"), "counts")
    vocab = vocabulary(counts, known.count())
    weights = train(known, vocab, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast((vocab, weights))
    numbered = plain.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    numbered_type = numbered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[int, object] = {}

        def narrow() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids.update(zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
                yield batch.select(["row", "text"])

        for found in _score_rows(narrow(), *shared.value):
            own = pa.array([ids.pop(r).as_py() for r in found.column(0).to_pylist()], id_type)
            yield pa.RecordBatch.from_arrays([*found.columns, own], [*found.schema.names, "doc_id"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(numbered.schema["doc_id"].dataType)
    scored = numbered.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        run, f"{SCORED}, doc_id {numbered_type}"
    )
    scored = scratch.keep(scored, "scored")
    tail = scored.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count("*").alias("k"))
    met = tail.join(counts, "word", "left").groupBy("row")
    rare = met.agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known"),
    )
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return (
        scored.drop("tail")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
            F.lit(vocab.tokens).cast("long").alias("train_tokens"),
            (F.col("heavy") + tail_log - F.col("n_tokens") * F.lit(vocab.base_norm())).alias("base_score"),
            (F.col("network") + F.col("rare") + tail_log).alias("score"),
        )
    )
