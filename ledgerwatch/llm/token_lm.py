"""Document scores by masked pseudo-likelihood over code points.

Tokens are code points as they are; the vocabulary is every code point of the
corpus, and a border token surrounds every text. A bidirectional window network
predicts each token from the three tokens on either side: embeddings by
position, summed, a tanh layer, a softmax over blocks of the vocabulary and one
inside the token's block. A code point outside the vocabulary (of a model that
was fitted on other texts) shares one token evenly with all others outside it.
A document's pseudo-log-likelihood is the sum over all its tokens of the
log-probability given both sides.

Counts of all code points come from all whole texts. The texts, long ones in
pieces, are dealt at random over partitions and rounds and checkpointed.
Training is data-parallel over them: each round every partition runs NumPy steps
on all windows of its texts of that round, so every window of the corpus is
learned from once, and parameters are averaged by Spark aggregations in two
levels, weighted by the windows seen. A partition's first texts are learned from
window by window; of the later ones, equal windows of some megabytes of text are
put together and count by their number, so a step covers more of the corpus. Only the averaged parameters (a fixed number for each token of the
vocabulary) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .textops import U64, frugal, mix, slices

SIDE = 3                        # tokens seen on either side
WINDOW = 2 * SIDE
POINTS = 0x110000
HIDDEN = 48
ROUNDS = 3
BATCH = 4096
LEAST_STEPS = 40                # of a partition in a round
DEALT = 1 << 14                 # code points dealt together at most
MIXED = 1 << 18                 # bytes of text whose windows are shuffled together
PLAIN = 1 << 20                 # code points of a partition in a round that are learned from window by window
GROUPED = 4 << 20               # code points whose equal windows are put together after that
HELD = 6 << 20                  # windows put together that are held, to be put together again, at most (about)
LOT = 32                        # equal windows in a row that is learned from, at most
PARTS = 12                      # training partitions at least
PART_TOKENS = 1 << 28           # tokens of the corpus for each training partition, on average
CHUNK = 1 << 16                 # parameters sent in a row
TOGETHER = 64                   # models added up in one group of the first level
SLICE = 2 << 20                 # bytes of text worked on at a time
LINE = 4 << 20                  # bytes of text scored together

BORDER = 0


class Model:
    """Parameters by name; tokens are 0 (border), 1.. (the vocabulary in the
    order given) and the last (any other code point). Blocks of the softmax hold
    about the square root of the vocabulary, most frequent tokens together where
    the vocabulary comes in order of frequency."""

    def __init__(self, vocabulary: np.ndarray, counts: np.ndarray):
        self.vocabulary = vocabulary
        self.size = len(vocabulary) + 2
        self.width = max(8, math.isqrt(self.size - 1) + 1)       # tokens in a block
        self.blocks = -(-self.size // self.width)
        self.shapes = {"embed": (WINDOW, self.size, HIDDEN), "bias": (HIDDEN,), "block": (HIDDEN, self.blocks), "block_base": (self.blocks,),
                       "out": (self.blocks, HIDDEN, self.width), "base": (self.blocks, self.width)}
        rng, count = np.random.default_rng(11), np.zeros(self.blocks * self.width)
        count[1: self.size] = 1.0
        count[1: self.size - 1] += counts
        count = count.reshape(self.blocks, self.width)
        with np.errstate(divide="ignore"):
            base, whole = np.log(count), np.log(count.sum(axis=1))
        whole[~np.isfinite(whole)] = -1e4
        base[~np.isfinite(base)] = -1e4             # the border, and places without a token
        parts = {"embed": rng.normal(0, 0.3, self.shapes["embed"]), "bias": np.zeros(HIDDEN), "block": rng.normal(0, 0.1, self.shapes["block"]),
                 "block_base": whole, "out": rng.normal(0, 0.1, self.shapes["out"]), "base": base}
        self.flat = np.concatenate([parts[n].ravel() for n in self.shapes]).astype(np.float32)
        self.unseen = math.log(POINTS - len(vocabulary))

    def parts(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        ends = np.cumsum([math.prod(s) for s in self.shapes.values()])
        return {n: p.reshape(s) for (n, s), p in zip(self.shapes.items(), np.split(flat, ends[:-1]))}

    def ids(self) -> np.ndarray:
        """The token of every code point."""
        out = np.full(POINTS, self.size - 1, np.int32)
        out[self.vocabulary] = np.arange(1, self.size - 1)
        return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Log-probabilities by row."""
    top = np.ascontiguousarray(logits.T).max(axis=0) if logits.shape[1] <= 32 else logits.max(axis=1)       # narrow rows are slow to reduce
    logits = logits - top[:, None]
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _hidden(p: dict, window: np.ndarray) -> np.ndarray:
    total = np.take(p["embed"][0], window[:, 0], axis=0)
    total += p["bias"]
    more = np.empty_like(total)
    for i in range(1, WINDOW):
        total += np.take(p["embed"][i], window[:, i], axis=0, out=more, mode="clip")       # clipping spares a buffer
    return np.tanh(total, out=total)


def _sorted(key: np.ndarray, most: int) -> np.ndarray:
    """The stable order of keys below ``most``; short integers sort by digits."""
    return np.argsort(key.astype(np.uint16) if most <= 1 << 16 else key, kind="stable")


def _picked(logits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of each row's log-probabilities the one at its place; ``logits`` is used up."""
    top = np.ascontiguousarray(logits.T).max(axis=0) if logits.shape[1] <= 32 else logits.max(axis=1)
    logits -= top[:, None]
    out = logits[np.arange(len(place)), place]
    np.exp(logits, out=logits)
    return out - np.log(logits.sum(axis=1))


def log_probability(model: Model, window: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Of every row's token in its window."""
    p, out = model.parts(model.flat), np.empty(len(token))
    for at in range(0, len(token), 1 << 13):
        t = token[at: at + (1 << 13)]
        hidden, block = _hidden(p, window[at: at + (1 << 13)]), t // model.width
        logp = _picked(hidden @ p["block"] + p["block_base"], block).astype(np.float64)
        order = _sorted(block, model.blocks)
        near, place, inside = hidden[order], (t % model.width)[order], np.empty(len(t), hidden.dtype)
        cuts = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), len(t)]
        for a, z in zip(cuts, cuts[1:]):
            b = int(block[order[a]])
            inside[a:z] = _picked(near[a:z] @ p["out"][b] + p["base"][b], place[a:z])
        logp[order] += inside
        out[at: at + (1 << 13)] = logp - np.where(t == model.size - 1, model.unseen, 0.0)
    return out


def gradients(model: Model, p: dict, window: np.ndarray, token: np.ndarray, weight: np.ndarray | None = None) -> list[tuple[str, object, np.ndarray]]:
    """Of the mean negative log-probability (rows count by ``weight``), as
    (parameter, where in it, values): only rows of embeddings and blocks of the
    softmax that occur."""
    n, every = len(token), np.arange(len(token))
    part = np.full((n, 1), n, p["bias"].dtype) if weight is None else (weight.sum() / weight).astype(p["bias"].dtype)[:, None]
    hidden, block = _hidden(p, window), token // model.width
    delta = np.exp(_softmax(hidden @ p["block"] + p["block_base"]))
    delta[every, block] -= 1
    delta /= part
    back = delta @ p["block"].T
    out = [("block", ..., hidden.T @ delta), ("block_base", ..., delta.sum(axis=0))]
    order = _sorted(block, model.blocks)
    cuts = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), n]
    near, place, part = hidden[order], token[order] % model.width, part[order]
    more = np.empty_like(back)
    for at, to in zip(cuts, cuts[1:]):
        b = int(block[order[at]])
        delta = np.exp(_softmax(near[at:to] @ p["out"][b] + p["base"][b]))
        delta[every[: to - at], place[at:to]] -= 1
        delta /= part[at:to]
        np.matmul(delta, p["out"][b].T, out=more[at:to])
        out += [("out", b, near[at:to].T @ delta), ("base", b, delta.sum(axis=0))]
    back[order] += more
    back *= 1 - hidden ** 2
    out.append(("bias", ..., back.sum(axis=0)))
    key = (window.T + np.arange(WINDOW)[:, None] * model.size).ravel()       # rows of the embeddings of all places
    order = _sorted(key, WINDOW * model.size)
    seen = key[order]
    first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
    out.append(("embed", np.divmod(seen[first], model.size), np.add.reduceat(np.take(back, order % n, axis=0), first, axis=0)))
    return out


def gradient(model: Model, flat: np.ndarray, window: np.ndarray, token: np.ndarray) -> np.ndarray:
    """``gradients`` as one vector like the parameters."""
    g = np.zeros_like(flat)
    d = model.parts(g)
    for name, where, values in gradients(model, model.parts(flat), window, token):
        d[name][where] = values
    return g


class Learner:
    """Adam on the parameters a batch touches; those of rows and blocks that
    don't occur in it rest, so a step costs the same for any vocabulary."""

    def __init__(self, model: Model):
        self.model, self.flat, self.step = model, model.flat.copy(), 0
        self.now, self.mean, self.square = (model.parts(x) for x in (self.flat, np.zeros_like(self.flat), np.zeros_like(self.flat)))

    def learn(self, window: np.ndarray, token: np.ndarray, weight: np.ndarray | None = None) -> None:
        self.step += 1
        rate, by = np.float32(0.01 / (1 - 0.9 ** self.step)), np.float32(1 - 0.999 ** self.step)
        for name, where, grad in gradients(self.model, self.now, window, token, weight):
            mean = self.mean[name][where] * np.float32(0.9) + np.float32(0.1) * grad
            square = self.square[name][where] * np.float32(0.999) + np.float32(0.001) * grad * grad
            self.mean[name][where], self.square[name][where] = mean, square
            self.now[name][where] -= rate * mean / (np.sqrt(square / by) + np.float32(1e-8))


def _pieces(text: str, size: int | None = None) -> list[tuple[str, str, str]]:
    """A text as (before, piece, after): pieces of ``size`` (else SLICE) code
    points with the SIDE code points around them."""
    size = size or SLICE
    return [(text[max(0, at - SIDE): at], text[at: at + size], text[at + size: at + size + SIDE]) for at in range(0, max(1, len(text)), size)]


class Line:
    """Some pieces of text as one line of tokens: ``spot``, where in it their
    tokens are, in order; ``counts``, the tokens of each piece."""

    def __init__(self, pieces: list[tuple[str, str, str]], ids: np.ndarray):
        parts, sizes = [], []
        for before, piece, after in pieces:
            parts += ["\0" * (SIDE - len(before)), before, piece, after, "\0" * (SIDE - len(after))]
            sizes.append((SIDE - len(before), len(before), len(piece), len(after)))
        line = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
        size = np.array(sizes, np.int64).reshape(-1, 4)
        self.counts = size[:, 2]
        self.tokens = ids[line]
        begin = np.cumsum(self.counts + 2 * SIDE) - (self.counts + 2 * SIDE)
        for j in range(SIDE):                       # places that no text reaches
            self.tokens[(begin + j)[size[:, 0] > j]] = BORDER
            self.tokens[(begin + 2 * SIDE + self.counts - 1 - j)[SIDE - size[:, 3] > j]] = BORDER
        total = int(self.counts.sum())
        self.spot = np.arange(total) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts) + np.repeat(begin + SIDE, self.counts)

    def windows(self, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows, tokens) at some places."""
        window = np.empty((WINDOW, len(spot)), np.intp)
        for i, j in enumerate(j for j in range(-SIDE, SIDE + 1) if j):
            window[i] = self.tokens[spot + j]
        return window.T, self.tokens[spot]


def _keys(line: Line, size: int) -> np.ndarray:
    """A number for the window of every token and the token itself."""
    bits = U64(max(1, (size - 1).bit_length()))
    exact = (WINDOW + 1) * int(bits) <= 64       # else a 64-bit fingerprint
    n = max(0, len(line.tokens) - WINDOW)
    key = np.zeros(n, U64)
    for j in range(WINDOW + 1):
        part = line.tokens[j: j + n].astype(U64)
        if exact:
            key <<= bits
            key |= part
        else:
            key = mix(key * U64(0x9E3779B97F4A7C15) + part + U64(1))
    return key[line.spot - SIDE]


def _equal(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the keys' order, where in it each distinct key begins, how often it occurs)."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(key)))


def _grouped(line: Line, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the keys of the distinct windows and tokens, ascending, a place of each, which of them every token has)."""
    key = _keys(line, size)
    every, bits = np.arange(len(key), dtype=np.int32), max(1, (len(key) - 1).bit_length())
    slot = (key * U64(0x9E3779B97F4A7C15) >> U64(64 - bits)).astype(np.intp)
    last = np.empty(1 << bits, np.int32)
    last[slot] = every                           # a slot stands for the last window in it
    same = last[slot]
    other = np.flatnonzero(key[same] != key)     # the other windows of a slot
    order, first, copies = _equal(key[other])
    same[other[order]] = np.repeat(other[order[first]], copies)
    at = np.flatnonzero(same == every)
    at = at[np.argsort(key[at])]
    last[at] = every[: len(at)]
    return key[at], line.spot[at], last[same]


def _distinct(line: Line, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct window and token, which of them every token has)."""
    return _grouped(line, size)[1:]


class Counts:
    """Windows and their tokens, equal ones put together: first those of some
    megabytes of text, then those of all that is held."""

    def __init__(self, model: Model, ids: np.ndarray):
        self.size, self.ids, self.kind = model.size, ids, np.uint16 if model.size <= 1 << 16 else np.int32
        self.parts, self.rows, self.tokens = [], 0, 0

    def add(self, pieces: list[tuple[str, str, str]]) -> None:
        line = Line(pieces, self.ids)
        key, spot, where = _grouped(line, self.size)
        window, token = line.windows(spot)
        self.parts.append((key, np.concatenate([window.T, token[None]]).astype(self.kind), np.bincount(where)))
        self.rows, self.tokens = self.rows + len(spot), self.tokens + len(where)

    def lots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(windows and tokens by column, which of them each lot is of, its
        number of equal windows, at most LOT); nothing is held after that."""
        key, column, copies = (np.concatenate(x, axis=-1) for x in zip(*self.parts))
        self.parts, self.rows, self.tokens = [], 0, 0
        order, first, _ = _equal(key)
        copies = np.add.reduceat(copies[order], first)
        lots = -(-copies // LOT)
        return column, np.repeat(order[first], lots), np.repeat((copies / lots).astype(np.float32), lots)


def _lines(batches: Iterator[pa.RecordBatch], ids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, Line, np.ndarray]]:
    """(rows, a line of them, the row of each of its pieces): some rows at a time, and a longer text's pieces one at a time."""
    for whole in batches:
        for batch in slices(whole, "text", LINE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if len(texts) == 1:
                for piece in _pieces(texts[0]):
                    yield batch, Line([piece], ids), np.zeros(1, np.int64)
            else:
                yield batch, Line([("", t, "") for t in texts], ids), np.arange(len(texts))


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(POINTS, np.int64)
    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            for text in batch.column("text").to_pylist():
                for _, piece, _ in _pieces(text or ""):
                    some = np.bincount(np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32))
                    seen[: len(some)] += some
    point = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(point.astype(np.int32)), pa.array(seen[point])], ["point", "n"])


def _deal(rounds: int):
    """All of a partition's texts in pieces, each dealt to a round and a random place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng = np.random.default_rng([17, TaskContext.get().partitionId()])
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                pieces = [p for t in batch.column("text").to_pylist() if t for p in _pieces(t, DEALT)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rng.integers(0, 1 << 62, len(pieces))), pa.array(rng.integers(0, rounds, len(pieces)).astype(np.int32)),
                     *[pa.array([p[i] for p in pieces], pa.string()) for i in range(3)]], ["place", "turn", "before", "text", "after"])
    return run


def _round(shared, number: int):
    """Train on all windows of a partition's pieces of text, read in order and
    shuffled some at a time, equal ones together after the first PLAIN code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        learner, rng = Learner(shared.value), np.random.default_rng([number, part])
        ids, first, seen, held = shared.value.ids(), None, 0, []
        counts = Counts(shared.value, ids)

        def learn_counts() -> int:
            tokens, (column, lot, copies) = counts.tokens, counts.lots()
            for some in np.array_split(rng.permutation(len(lot)), -(-len(lot) // BATCH)):
                rows = column[:, lot[some]].astype(np.intp)
                learner.learn(rows[:-1].T, rows[-1], copies[some])
            return tokens

        for whole in batches:
            for batch in slices(whole, "text", MIXED):
                pieces = list(zip(*(batch.column(c).to_pylist() for c in ("before", "text", "after"))))
                if seen >= PLAIN:
                    held += pieces
                    if sum(len(p[1]) for p in held) >= GROUPED:
                        counts.add(held)
                        held = []
                        if counts.rows >= HELD:
                            seen += learn_counts()
                    continue
                line = Line(pieces, ids)
                spot = rng.permutation(line.spot)
                if first is None:                  # kept for partitions with too few windows for LEAST_STEPS
                    first = line.windows(spot[: LEAST_STEPS * BATCH])
                steps = max(1, -(-len(spot) // BATCH))
                for some in np.array_split(spot, steps):
                    learner.learn(*line.windows(some))
                seen += len(spot)
        if held:
            counts.add(held)
        if counts.rows:
            seen += learn_counts()
        if seen:
            while learner.step < LEAST_STEPS:
                some = rng.integers(0, len(first[1]), BATCH)
                learner.learn(first[0][some], first[1][some])
            at = range(0, len(learner.flat), CHUNK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(at), dtype=np.int32)), pa.array(np.full(len(at), part // TOGETHER, np.int32)),
                 pa.array([(learner.flat[a: a + CHUNK].astype(np.float64) * seen).tobytes() for a in at], pa.binary()), pa.array(np.full(len(at), float(seen)))], ["place", "level", "part", "weight"])
    return run


def _sum(table: pa.Table) -> pa.Table:
    total = 0.0
    for part in table.column("part"):
        total = total + np.frombuffer(part.as_buffer(), np.float64)
    return pa.table({"place": table.column("place").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary()), "weight": pa.array([sum(table.column("weight").to_pylist())])})


SUMMED = "place int, part binary, weight double"


def fit(docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """The network, learned from every window of ``docs``."""
    spark = docs.sparkSession
    points = docs.select("text").mapInArrow(frugal(_points), "point int, n long").groupBy("point").agg(F.sum("n").alias("n")).collect()       # at most all code points
    points = sorted(((r["point"], r["n"]) for r in points), key=lambda r: (-r[1], r[0]))
    model = Model(np.array([p for p, _ in points], np.int64), np.array([n for _, n in points], np.float64))
    if not points:
        return model
    tokens = sum(n for _, n in points)
    number = max(PARTS, tokens // PART_TOKENS + 1)
    ensure_checkpoint_dir(spark)
    dealt = docs.select("text").mapInArrow(frugal(_deal(rounds)), "place long, turn int, before string, text string, after string")
    dealt = dealt.repartition(number, "place").checkpoint()
    for i in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        new = dealt.where(F.col("turn") == i).mapInArrow(frugal(_round(shared, i)), "place int, level int, part binary, weight double")
        sums = new.groupBy("place", "level").applyInArrow(_sum, SUMMED).groupBy("place").applyInArrow(_sum, SUMMED)
        sums = sorted(sums.collect(), key=lambda r: r["place"])
        if sums:                # else no piece of a small corpus was dealt to this round
            model.flat = np.concatenate([np.frombuffer(r["part"], np.float64) / r["weight"] for r in sums]).astype(np.float32)
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        ids = model.ids()

        def out(batch: pa.RecordBatch, count: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(count), pa.array(total)], ["doc_id", "n_tokens", "log_likelihood"])

        open_batch, count, total = None, None, None
        for batch, line, row in _lines(batches, ids):
            if batch is not open_batch:
                if open_batch is not None:
                    yield out(open_batch, count, total)
                open_batch, count, total = batch, np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            spot, where = _distinct(line, model.size)
            some = np.flatnonzero(line.counts)
            begin = np.cumsum(line.counts) - line.counts
            count[row] += line.counts
            if len(some):       # each piece's sum by itself, so that it doesn't depend on its neighbours
                total[row[some]] += np.add.reduceat(log_probability(model, *line.windows(spot))[where], begin[some])
        if open_batch is not None:
            yield out(open_batch, count, total)
    return run


def score_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens,
    log_likelihood (sum over the whole text's tokens) and mean_log_likelihood.
    Without ``model`` one is fitted on all of ``docs``.

    Null and empty texts have no tokens, log-likelihood 0 and a null mean. A
    null doc_id is returned as null, repeated rows are scored each (and counted
    each in fitting), other columns are ignored, an empty table gives no rows. A
    text is read in one task, a piece of SLICE code points at a time, with the
    code points around each piece seen."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs) if model is None else model)
    scored = docs.select("doc_id", "text").mapInArrow(frugal(_score(shared)), "doc_id long, n_tokens long, log_likelihood double")
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
