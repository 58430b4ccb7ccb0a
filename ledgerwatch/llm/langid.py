"""Language labels for the words of code-switched text by a linear-chain
conditional random field.

A word's features are its first and last one to three bytes (affixes), its
byte trigrams with the word's borders, and the word itself (lexicon), hashed
into one weight table with a column per language. Learned transitions tie
neighbouring words. Forward-backward gives each word's posterior; a document's
language is the one with the largest mean posterior over its words.

Words are maximal runs of ASCII letters and other non-ASCII code points than
separators, punctuation and controls, A-Z lower-cased.
Long documents are cut into segments whose transfer matrices are multiplied
first, so forward-backward over a whole document is exact and takes few steps.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import _LOWER, U64, frugal, mix, prefix_sums, slices, span_hash

TRAIN_DOCS = 500         # labelled documents per language to learn from, on average (the bounded sample)
TRAIN_WINDOWS = 4        # windows taken of each, from anywhere in its text
WINDOW = 48              # words in a window
WINDOW_BYTES = 4096      # a window with more bytes is cut here, between code points
EPOCHS = 3
TABLE_BITS = 18
SEGMENT = 256            # words per segment of forward-backward
SLICE = 512 << 10        # bytes of text worked on at a time
MOST_LANGUAGES = 512     # labels the driver and every worker can hold weights for (2**18 floats each)
UNDETERMINED = "und"
STOPS = ("Zs", "Zl", "Zp", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Cc")     # Unicode categories that end a word
HAS_WORDS = r"\p{L}"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


@functools.cache
def _stops() -> np.ndarray:
    """By code point: separators, punctuation and controls beyond ASCII."""
    out = np.zeros(0x200000, bool)
    out[[c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) in STOPS]] = True
    return out


def letters(raw: np.ndarray) -> np.ndarray:
    """Whether each byte of some UTF-8 text, which ends in ASCII, belongs to a word."""
    out = _LETTER[raw]
    for least, most, more in ((0xC2, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF8, 3)):
        at = np.flatnonzero((raw >= least) & (raw < most))
        code = raw[at].astype(np.int64) & (0x3F >> more)
        for j in range(1, more + 1):
            code = (code << 6) | (raw[at + j] & 0x3F)
        at = at[_stops()[code]]
        for j in range(more + 1):
            out[at + j] = False
    return out


class Words:
    """The words of some texts, with their feature ids."""

    def __init__(self, texts: list[str]):
        encoded = [t.encode() for t in texts]
        size = np.array([len(e) for e in encoded], np.int64)
        self.raw = np.frombuffer(b"\n\n\n" + b"\n".join(encoded) + b"\n\n\n", np.uint8)
        begin = 3 + np.cumsum(size + 1) - (size + 1)
        self.begin = begin
        letter = letters(self.raw)
        clean = np.where(letter, _LOWER[self.raw], 32).astype(np.uint8)
        edge = np.diff(letter.astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        self.counts = np.searchsorted(self.start, begin + size) - np.searchsorted(self.start, begin)
        wide = clean.astype(np.uint32)
        self.code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        self.clean = clean

    @staticmethod
    def _slot(code: np.ndarray, kind: int) -> np.ndarray:
        return ((code * np.uint32(2654435761) + np.uint32((kind * 0x9E3779B9) & 0xFFFFFFFF)) * np.uint32(2246822519)) >> np.uint32(32 - TABLE_BITS)

    def word_features(self) -> np.ndarray:
        """One column per affix and the word itself."""
        head, tail = self.code[self.start], self.code[self.end - 3]
        out = [self._slot(head >> np.uint32(s), 1 + i) for i, s in enumerate((16, 8, 0))]
        out += [self._slot(tail & np.uint32(m), 4 + i) for i, m in enumerate((0xFF, 0xFFFF, 0xFFFFFF))]
        whole = np.empty(len(self.start), U64)
        at = 0
        while at < len(self.start):         # in chunks cut between words
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + (1 << 21), "right")))
            prefix = prefix_sums(self.clean[base: self.end[to - 1]])
            whole[at:to] = span_hash(prefix, self.start[at:to] - base, self.end[at:to] - base)
            at = to
        out.append((whole >> U64(64 - TABLE_BITS)).astype(np.uint32))
        return np.stack(out, axis=1)

    def trigram_slots(self) -> np.ndarray:
        """The feature of the trigram at every byte; a word's trigrams begin
        from one byte before it to two before its end."""
        return self._slot(self.code, 0)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros((0, weights.shape[1]), np.float32)
        out = np.zeros((len(self.start), weights.shape[1]), np.float32)
        for column in self.word_features().T:
            out += weights[column]
        slots = self.trigram_slots()
        bounds = np.stack([self.start - 1, self.end - 1], axis=1).ravel()
        for k in range(weights.shape[1]):
            out[:, k] += np.add.reduceat(weights[:, k][slots], bounds)[::2]
        return out


def posteriors(emission: np.ndarray, counts: np.ndarray, trans: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Posterior of every word's label, by exact forward-backward over each
    row's whole word sequence."""
    n, k = emission.shape
    move = np.exp(trans - trans.max()).astype(np.float64)
    local = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float64)
    first = np.cumsum(counts) - counts
    pieces = -(-counts // SEGMENT)
    row = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = first[row] + number * SEGMENT
    size = np.minimum(SEGMENT, counts[row] - number * SEGMENT)
    order = np.argsort(-size, kind="stable")
    begin_o, size_o = begin[order], size[order]
    active = [int(np.searchsorted(-size_o, -t, "left")) for t in range(int(size.max(initial=0)))]     # segments longer than t
    # transfer matrices of segments, only needed where a row has several
    several = pieces[row[order]] > 1
    transfer = np.tile(np.eye(k), (len(row), 1, 1))
    if several.any():
        which = np.flatnonzero(several)
        m = np.tile(np.eye(k), (len(which), 1, 1))
        for t in range(int(size_o[which].max())):
            a = int(np.searchsorted(-size_o[which], -t, "left"))
            m[:a] = (m[:a] @ move) * local[begin_o[which[:a]] + t][:, None, :]
            m[:a] /= m[:a].sum(axis=(1, 2), keepdims=True)
        transfer[order[which]] = m
    # messages at segment borders, row by row
    forward, backward = np.empty((len(row), k)), np.ones((len(row), k))
    head = np.cumsum(pieces) - pieces
    at = np.exp(prior - prior.max())
    forward[head[pieces > 0]] = at / at.sum()
    for j in range(1, int(pieces.max(initial=0))):
        who = head[pieces > j] + j
        v = np.einsum("ij,ijk->ik", forward[who - 1], transfer[who - 1])
        forward[who] = v / v.sum(axis=1, keepdims=True)
    tail = head + pieces - 1
    for j in range(1, int(pieces.max(initial=0))):
        who = tail[pieces > j] - j
        v = np.einsum("ijk,ik->ij", transfer[who + 1], backward[who + 1])
        backward[who] = v / v.sum(axis=1, keepdims=True)
    # inside all segments at once
    alpha = np.empty((n, k))
    state = forward[order]
    for t, a in enumerate(active):
        v = (state[:a] @ move) * local[begin_o[:a] + t]
        v /= v.sum(axis=1, keepdims=True)
        state[:a] = v
        alpha[begin_o[:a] + t] = v
    state = backward[order]
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        spot = begin_o[:a] + t
        alpha[spot] *= state[:a]
        v = (local[spot] * state[:a]) @ move.T
        state[:a] = v / v.sum(axis=1, keepdims=True)
    return alpha / alpha.sum(axis=1, keepdims=True)


def expectations(emission: np.ndarray, counts: np.ndarray, trans: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By forward-backward over some short sequences: every word's label
    posterior, the expected number of each transition between words, the
    posterior of each sequence's start state, and of (start state, first
    label)."""
    k, n, steps = emission.shape[1], len(counts), int(counts.max(initial=0))
    move = np.exp(trans - trans.max())
    local = np.exp(emission - emission.max(axis=1, keepdims=True))
    first = np.cumsum(counts) - counts
    spot = np.minimum(first[:, None] + np.arange(steps), len(emission) - 1)      # [sequence, word]
    live = np.arange(steps) < counts[:, None]
    seen = np.where(live[:, :, None], local[spot], 1.0)
    start = np.exp(prior - prior.max())
    alpha, beta = np.empty((steps, n, k)), np.ones((steps, n, k))
    state = np.tile(start, (n, 1))
    for t in range(steps):
        state = (state @ move) * seen[:, t]
        state /= state.sum(axis=1, keepdims=True)
        alpha[t] = state
    for t in range(steps - 2, -1, -1):
        ahead = (seen[:, t + 1] * beta[t + 1]) @ move.T
        beta[t] = np.where(live[:, t + 1, None], ahead / ahead.sum(axis=1, keepdims=True), 1.0)
    gamma, pairs = np.empty_like(local), np.zeros((k, k))
    for t in range(steps):
        on = np.flatnonzero(live[:, t])
        both = alpha[t, on] * beta[t, on]
        gamma[spot[on, t]] = both / both.sum(axis=1, keepdims=True)
        if t:
            joint = alpha[t - 1, on][:, :, None] * move * (seen[on, t] * beta[t, on])[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    opening = start[None, :, None] * move * (seen[:, 0] * beta[0])[:, None, :]
    opening /= opening.sum(axis=(1, 2), keepdims=True)
    return gamma, pairs, opening.sum(axis=2), opening


def chain_gradient(emission: np.ndarray, counts: np.ndarray, truth: np.ndarray, trans: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The gradient of the log-likelihood of the labels ``truth``, summed over
    sequences, by word scores, transitions and start scores. The state before
    the first word isn't labelled, so its posterior given the first label
    stands for what is observed."""
    gamma, pairs, begun, opening = expectations(emission, counts, trans, prior)
    by_word = -gamma
    by_word[np.arange(len(truth)), truth] += 1
    first = np.cumsum(counts) - counts
    by_trans = -pairs - opening.sum(axis=0)
    inner = np.ones(len(truth), bool)
    inner[first] = False
    after = np.flatnonzero(inner)
    np.add.at(by_trans, (truth[after - 1], truth[after]), 1)
    known = prior[None, :] + trans[:, truth[first]].T
    known = np.exp(known - known.max(axis=1, keepdims=True))
    known /= known.sum(axis=1, keepdims=True)
    np.add.at(by_trans.T, truth[first], known)
    return by_word, by_trans, (known - begun).sum(axis=0)


def train(windows: list[tuple[str, str]], languages: list[str], seed: int = 5) -> dict:
    """Weights, transitions and prior by AdaGrad on the conditional
    likelihood. ``windows``: (language, text). Half of the sequences join parts
    of two windows of different languages, so that the transitions are learned
    from code-switched text."""
    k, rng = len(languages), np.random.default_rng(seed)
    label_of = {name: i for i, name in enumerate(languages)}
    words = Words([t for _, t in windows])
    columns = words.word_features() if len(words.start) else np.zeros((0, 7), np.uint32)
    slots = words.trigram_slots()
    first = np.cumsum(words.counts) - words.counts
    names = np.array([label_of[name] for name, _ in windows], np.int64)
    by = [np.flatnonzero((names == i) & (words.counts > 0)) for i in range(k)]
    weights, trans, prior = np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((k, k)), np.zeros(k)
    square, square_t, square_p = np.full(weights.shape, 1e-3, np.float32), np.full((k, k), 1e-1), np.full(k, 1e-1)
    usable = np.flatnonzero(words.counts > 0)
    for _ in range(EPOCHS if k > 1 else 0):
        sequences = [(np.arange(first[w], first[w] + words.counts[w]), np.full(words.counts[w], names[w])) for w in usable.tolist()]
        for _ in range(len(sequences)):
            a, b = rng.choice([i for i in range(k) if len(by[i])], 2)
            x, y = rng.choice(by[a]), rng.choice(by[b])
            i, j = rng.integers(0, words.counts[x] + 1), rng.integers(0, words.counts[y] + 1)
            index = np.concatenate([np.arange(first[x], first[x] + i), np.arange(first[y] + j, first[y] + words.counts[y])])
            if len(index):
                sequences.append((index, np.concatenate([np.full(i, a), np.full(words.counts[y] - j, b)])))
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), 256):
            some = [sequences[i] for i in order[at: at + 256]]
            index, truth = np.concatenate([s[0] for s in some]), np.concatenate([s[1] for s in some])
            counts = np.array([len(s[0]) for s in some])
            span = words.end[index] - words.start[index]
            tri = np.repeat(words.start[index] - 1, span) + np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span)
            flat = np.concatenate([columns[index].ravel(), slots[tri]]).astype(np.int64)
            owner = np.concatenate([np.repeat(np.arange(len(index)), columns.shape[1]), np.repeat(np.arange(len(index)), span)])
            emission = np.stack([np.bincount(owner, weights[flat, c], len(index)) for c in range(k)], axis=1)
            error, grad_t, grad_p = chain_gradient(emission, counts, truth, trans, prior)
            grad_t, grad_p = grad_t / len(index), grad_p / len(some)
            square_t += grad_t ** 2
            trans += 0.5 * grad_t / np.sqrt(square_t)
            square_p += grad_p ** 2
            prior += 0.1 * grad_p / np.sqrt(square_p)
            touched = np.unique(flat)
            for c in range(k):
                g = np.bincount(flat, error[owner, c], len(weights))[touched] / len(some)
                square[touched, c] += g ** 2
                weights[touched, c] += 0.2 * g / np.sqrt(square[touched, c])
    return {"languages": languages, "weights": weights, "trans": trans, "prior": prior}


def _windows(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                out = []
                for doc, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                    words = Words([text or ""])
                    n = int(words.counts[0])
                    starts = np.arange(0, n, WINDOW)
                    spread = mix(np.arange(len(starts), dtype=U64) + U64((doc & 0xFFFFFFFF) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                    for s in np.sort(starts[np.argsort(spread, kind="stable")[:most]]).tolist():
                        part = words.raw[words.start[s]: words.end[min(n, s + WINDOW) - 1]]
                        to = min(len(part), WINDOW_BYTES)
                        while to < len(part) and part[to] & 0xC0 == 0x80:
                            to -= 1
                        out.append((doc, lang, s, part[:to].tobytes().decode("utf-8", "replace")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.string()))], ["doc_id", "lang", "at", "text"])
    return run


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def largest_hash(train_docs: float, count: int) -> int:
    """The signed 64-bit hash up to which ``train_docs`` of ``count`` documents lie on average."""
    return min(2 ** 64 - 1, int(train_docs * 2 ** 64) // count) - 2 ** 63


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """A model from ``docs`` (doc_id, text, lang): rows with words, a lang and
    a doc_id whose crc32 modulo 3 is not 1. About ``train_docs`` documents per
    language (all, where there are fewer), chosen by hash, give up to
    TRAIN_WINDOWS windows of their whole text each; only these reach the
    driver, where the small model is fitted. More than MOST_LANGUAGES values of
    lang, and a language of which no window was met, are errors."""
    known = docs.where("lang is not null and doc_id is not null").where(~held_out()).where(F.col("text").rlike(HAS_WORDS))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    languages = sorted(counts)
    if not languages:
        return {"languages": [], "weights": np.zeros((1 << TABLE_BITS, 1), np.float32), "trans": np.zeros((1, 1)), "prior": np.zeros(1)}
    most = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(largest_hash(train_docs, counts[name])).cast("long"))])
    picked = known.where(F.xxhash64("doc_id", F.lit(9)) <= most[F.col("lang")])
    rows = picked.select("doc_id", "lang", "text").mapInArrow(_windows(TRAIN_WINDOWS), "doc_id long, lang string, at long, text string").collect()
    bare = set(languages) - {r["lang"] for r in rows}
    if bare:
        raise ValueError(f"labelled text, but no training window of {sorted(bare)}: train_docs is too small")
    return train([(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["at"], r["text"]))], languages)


SCHEMA = "doc_id long, lang_scores array<double>, words int, segments array<struct<start:int,end:int,lang:string,score:double>>"


def _label(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages, k = model["languages"], model["weights"].shape[1]
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                words = Words([t or "" for t in batch.column("text").to_pylist()])
                gamma = posteriors(words.emissions(model["weights"]), words.counts, model["trans"], model["prior"])
                counts, n = words.counts, len(words.counts)
                total = np.concatenate([np.zeros((1, k)), np.cumsum(gamma, axis=0)])
                ends = np.cumsum(counts)
                mean = (total[ends] - total[ends - counts]) / np.maximum(counts, 1)[:, None]
                label = gamma.argmax(axis=1)
                doc = np.repeat(np.arange(n), counts)
                cut = np.ones(len(label), bool)
                cut[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(cut)
                last = np.append(first[1:], len(label))[: len(first)] - 1
                best = gamma[np.arange(len(label)), label] if len(label) else np.zeros(0)
                run_score = np.add.reduceat(best, first) / (last - first + 1) if len(first) else np.zeros(0)
                points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])      # code points before each byte
                base = points[words.begin[doc[first]]] if len(first) else first
                segments = pa.StructArray.from_arrays([
                    pa.array((points[words.start[first]] - base).astype(np.int32)), pa.array((points[words.end[last]] - base).astype(np.int32)),
                    pa.array([languages[i] for i in label[first].tolist()] if languages else [], pa.string()), pa.array(run_score)], ["start", "end", "lang", "score"]) if languages else pa.array(
                    [], pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("score", pa.float64())]))
                runs = np.searchsorted(doc[first], np.arange(n + 1)) if languages else np.zeros(n + 1, np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * k).astype(np.int32)), pa.array(mean.ravel())),
                    pa.array(counts.astype(np.int32)), pa.ListArray.from_arrays(pa.array(runs.astype(np.int32)), segments)],
                    ["doc_id", "lang_scores", "words", "segments"])
    return run


def label_words(docs: DataFrame, model: dict) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_scores (mean posterior
    of each language, in the model's order), words, and segments: runs of words
    of one language (start and end code point, lang, mean posterior). Reads the
    whole text; null and texts without words have no segments and zero scores.
    A text is worked on in one task (about 100 bytes of memory per byte)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(frugal(_label(shared)), SCHEMA)


def predict(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    lang_pred is the language with the largest mean posterior over the words of
    the whole text (ties: the first by name), score that mean. It is ``und``
    with score 0 for a null text, a text without letters, or a model without
    languages. Without ``model`` one is fitted on ``docs`` (see ``fit``).
    A null doc_id is not held out and never learned from; repeated rows are
    predicted each; other columns are ignored; an empty table gives no rows."""
    model = model or fit(docs)
    names = F.array(*map(F.lit, model["languages"] or [UNDETERMINED]))
    texts = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    best = F.array_max("lang_scores")
    sure = F.col("words") > 0 if model["languages"] else F.lit(False)
    return label_words(texts, model).select(
        "doc_id", held_out().alias("held_out"),
        F.when(sure, F.element_at(names, F.array_position("lang_scores", best).cast("int"))).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(sure, F.least(best, F.lit(1.0))).otherwise(0.0).alias("score"))


def certainty(best: np.ndarray, languages: int) -> np.ndarray:
    """The largest of the posteriors on a scale from 0 (all languages alike) to 1."""
    even = 1 / max(1, languages)
    return (best - even) / (1 - even) if languages > 1 else np.ones_like(best)


def identified(docs: DataFrame, least: float = 0.35, model: dict | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose words are labelled with a
    certainty of at least ``least``: the mean over words of the largest
    posterior, rescaled so that 0 is what a guess among all languages gives
    (see ``certainty``). What is rejected has no letters, or words that belong
    to no language rather than another; code-switched text stays, however many
    languages it holds. Where a column lang is null it gets the predicted
    language.

    Null texts and texts without letters go; repeated rows are judged each; a
    null doc_id and extra columns, whatever their names, stay as they are; an
    empty table, or one without any labelled text to learn from, gives no rows.
    Every row is judged in place by its own text, without a shuffle."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages = pa.array(model["languages"], pa.string())
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                words = Words([t or "" for t in batch.column("text").to_pylist()])
                gamma = posteriors(words.emissions(model["weights"]), words.counts, model["trans"], model["prior"])
                ends, some = np.cumsum(words.counts), np.maximum(words.counts, 1)
                total = np.concatenate([[0.0], np.cumsum(certainty(gamma.max(axis=1), len(languages)))])
                good = (words.counts > 0) & (total[ends] - total[ends - words.counts] >= least * some)
                by = np.concatenate([np.zeros((1, gamma.shape[1])), np.cumsum(gamma, axis=0)])
                best = (by[ends] - by[ends - words.counts]).argmax(axis=1)
                at = batch.schema.get_field_index("lang")
                if at >= 0 and pa.types.is_string(batch.schema.field(at).type):
                    batch = batch.set_column(at, batch.schema.field(at), pc.fill_null(batch.column(at), languages.take(pa.array(best)))) if batch.column(at).null_count else batch
                yield batch.filter(pa.array(good))

    if not model["languages"]:
        return docs.limit(0)
    return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(frugal(run), schema)
