"""Byte-pair encoding and decoding of whole texts.

Merging follows a segment tree over the adjacent pairs of a piece: a leaf
holds ``rank * width + place`` of the pair that begins there (or "none"), an
inner node the smaller of its children, so the root is the leftmost pair of
lowest rank. A merge updates at most three leaves and their paths, which costs
a logarithm of the piece's length, until the root holds none.

Short pieces (nearly all) run in lockstep, one NumPy row of the tree each;
longer ones use the same tree as plain lists.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import give_back, slices

# fixed value: the published byte-level pre-tokenizer's pattern
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# the same pattern with its classes spelled out for texts below U+0250, which the plain regex engine matches faster
LATIN = re.compile(r"[\0-\u024f]*")
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
LATIN_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_L}{_N}{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
LOCKSTEP = 64             # widest piece, in bytes, merged in lockstep
CACHED = 400_000          # pieces remembered inside a partition; older ones are worked out again
NONE = np.int32(np.iinfo(np.int32).max)
SLOTS = 1 << 18           # of the open-addressed table of mergeable pairs
_loaded: dict[str, Vocabulary] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for
    themselves, all others for code points from 256 on, in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and added tokens of a byte-level BPE file, read once per
    worker, with the pieces encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()
        ids = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(symbol[c] for c in name) for name, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: name.encode() for name, i in self.added.items()}
        self.first = np.zeros(256, np.int64)
        for name, i in ids.items():
            if len(name) == 1:
                self.first[symbol[name]] = i
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ids = max(self.bytes_of) + 1
        left, right = (np.array([ids[m[i]] for m in merges], np.uint64) for i in (0, 1))
        self.made = np.array([ids[a + b] for a, b in merges], np.int32)
        self.lookup = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right))}
        self.keys, self.ranks = np.zeros(SLOTS, np.uint64), np.full(SLOTS, NONE, np.int32)
        wanted = left * np.uint64(self.ids) + right + np.uint64(1)      # 0 marks a free slot
        at, rest = self._slot(wanted), np.arange(len(wanted))
        while len(rest):
            free = rest[self.keys[at[rest]] == 0]
            self.keys[at[free]] = wanted[free]                          # of several, the last one gets the slot
            got = free[self.keys[at[free]] == wanted[free]]
            self.ranks[at[got]] = got
            rest = np.setdiff1d(rest, got)
            at[rest] = (at[rest] + 1) % SLOTS
        byte = self.first.astype(np.int32)
        self.byte_ranks = self.rank(np.repeat(byte, 256), np.tile(byte, 256))
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.known: dict[str, bytes] = {}      # ids as int32 bytes, which join without making Python ints

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE if it doesn't merge."""
        wanted = left.astype(np.uint64) * np.uint64(self.ids) + right.astype(np.uint64) + np.uint64(1)
        at = self._slot(wanted)
        there = self.keys[at]
        out = np.where(there == wanted, self.ranks[at], NONE)
        rest = np.flatnonzero((there != wanted) & (there != 0))
        while len(rest):
            at[rest] = (at[rest] + 1) % SLOTS
            there = self.keys[at[rest]]
            hit = there == wanted[rest]
            out[rest[hit]] = self.ranks[at[rest[hit]]]
            rest = rest[~hit & (there != 0)]
        return out

    def merge_one(self, raw: bytes) -> bytes:
        """The ids of one piece, by the tree as plain lists."""
        sym = self.first[list(raw)].tolist()
        n = len(sym)
        width = 1 << max(1, (n - 1).bit_length())
        none = 1 << 62
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)

        def rank(i: int) -> int:
            if i < 0 or after[i] >= n:
                return none
            found = self.lookup.get((sym[i], sym[after[i]]))
            return none if found is None else found * width + i

        for i in range(n):
            tree[width + i] = rank(i)
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def update(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                best = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == best:
                    break
                tree[i] = best

        while tree[1] < none:
            i = tree[1] % width
            j = after[i]
            sym[i] = int(self.made[tree[1] // width])
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            update(j, none)
            update(i, rank(i))
            if before[i] >= 0:
                update(before[i], rank(before[i]))
        out, i = [], 0
        while i < n:
            out.append(sym[i])
            i = after[i]
        return np.array(out, np.int32).tobytes()

    def merge_many(self, raws: list[bytes], width: int) -> list[bytes]:
        """The ids of many pieces of 2 to ``width`` bytes (a power of two),
        all trees advancing by one merge at a time."""
        rows, bits = len(raws), width.bit_length() - 1
        size = np.array([len(r) for r in raws], np.int64)
        flat = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in raws]), np.uint8).reshape(rows, width)
        # nodes are numbered row * width + place; -1 is none
        node = np.arange(rows * width).reshape(rows, width)
        place = np.arange(width)
        alive = (place[None, :] < size[:, None]).ravel()
        sym = self.first[flat].astype(np.int32).ravel()
        after = np.where(place[None, :] + 1 < size[:, None], node + 1, -1).ravel()
        before = np.where(place[None, :] > 0, node - 1, -1).ravel()
        tree = np.full((rows, 2 * width), NONE, np.int32)
        rank = self.byte_ranks[flat[:, :-1].astype(np.int32) * 256 + flat[:, 1:]]
        good = (rank < NONE) & (place[None, 1:] < size[:, None])
        tree[:, width: 2 * width - 1] = np.where(good, (rank << bits) | place[None, :-1], NONE)
        for i in range(width - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
        tree = tree.ravel()

        def leaf(at: np.ndarray) -> np.ndarray:
            """Tree value of the pair that begins at each node."""
            to = after[at]
            value = self.rank(sym[at], sym[to])
            return np.where((to >= 0) & (value < NONE), (value << bits) | (at & (width - 1)), NONE)

        live = np.arange(rows)
        root = tree[1:: 2 * width]
        while True:
            more = np.flatnonzero(root < NONE)
            if not len(more):
                break
            live, root = live[more], root[more]
            at = (live << bits) + (root & (width - 1))
            to = after[at]
            sym[at] = self.made[root >> bits]
            alive[to] = False
            behind = after[to]
            after[at] = behind
            inner = behind >= 0
            before[behind[inner]] = at[inner]
            prev = before[at]
            prev = prev[prev >= 0]
            touched = np.concatenate([at, prev])
            value = np.concatenate([leaf(touched), np.full(len(to), NONE)])
            touched = np.concatenate([touched, to])
            base = (touched >> bits) << (bits + 1)
            spot = (touched & (width - 1)) + width
            tree[base + spot] = value
            for _ in range(bits):
                spot >>= 1
                here = base + spot
                child = here + spot
                tree[here] = np.minimum(tree[child], tree[child + 1])
            root = tree[(live << (bits + 1)) + 1]
        ends = (4 * np.cumsum(alive.reshape(rows, width).sum(axis=1))).tolist()
        ids = sym[alive].tobytes()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def learn(self, pieces: set[str]) -> None:
        """Work out new pieces."""
        if len(self.known) + len(pieces) > CACHED:
            self.known = {}
        widths: dict[int, tuple[list[str], list[bytes]]] = {}
        for p in pieces:
            raw = p.encode()
            names, raws = widths.setdefault(1 << (len(raw) - 1).bit_length(), ([], []))
            names.append(p)
            raws.append(raw)
        for width, (names, raws) in widths.items():
            if width == 1:
                self.known.update((p, self.first[r[0]].astype(np.int32).tobytes()) for p, r in zip(names, raws))
            elif width > LOCKSTEP:
                self.known.update((p, self.merge_one(r)) for p, r in zip(names, raws))
            else:
                for at in range(0, len(raws), 1 << 12):
                    self.known.update(zip(names[at: at + (1 << 12)], self.merge_many(raws[at: at + (1 << 12)], width)))

    def cut(self, text: str) -> list[str | bytes]:
        """Pre-tokens of a text; an added token's string is its id, as bytes."""
        find = LATIN_PIECES.findall if LATIN.fullmatch(text) else PIECES.findall
        if self.split is None or not any(t in text for t in self.added):
            return find(text)
        parts = self.split.split(text)
        return list(chain.from_iterable([np.int32(self.added[p]).tobytes()] if p in self.added else find(p) for p in parts))

    def encode_batch(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end."""
        known = self.known
        cut = [self.cut(t) for t in texts]
        found = [list(map(known.get, pieces)) for pieces in cut]
        new = {p for pieces, got in zip(cut, found) if None in got for p, x in zip(pieces, got) if x is None}
        self.learn({p for p in new if p.__class__ is str})
        known = self.known
        ids = [b"".join([x or known.get(p, p) for p, x in zip(pieces, got)] if None in got else got) for pieces, got in zip(cut, found)]
        return np.frombuffer(b"".join(ids), np.int32), np.cumsum([0, *map(len, ids)]).astype(np.int32) // 4

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in a row, with each id's start and length."""
        if not hasattr(self, "_tables"):
            n = max(self.bytes_of) + 1
            parts = [self.bytes_of.get(i, b"") for i in range(n)]
            size = np.array([len(p) for p in parts], np.int64)
            self._tables = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size
        return self._tables

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that aren't UTF-8 become U+FFFD, unknown
        ids nothing."""
        flat, start, size = self.tables()
        ids = ids[(ids >= 0) & (ids < len(size))]
        n = size[ids]
        ends = np.cumsum(n)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[ids] - (ends - n), n)
        return flat[where].tobytes().decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def forget(vocab: Vocabulary) -> None:
    """Drop the pieces remembered, at the end of a partition."""
    vocab.known = {}
    give_back()


def _encoder(path: str, column: str, check: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for whole in batches:
            for batch in slices(whole, column, 2 << 20):
                ids, ends = vocab.encode_batch(t or "" for t in batch.column(column).to_pylist())
                columns, names = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], [*batch.schema.names, "ids"]
                if check:
                    columns.append(pa.array([vocab.decode(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
        forget(vocab)
    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            ends = ids.offsets.to_numpy() - ids.offsets[0].as_py() if len(ids) else np.zeros(1, np.int64)
            texts = [vocab.decode(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])
    return run


def encode(docs: DataFrame, path: str | None = None, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>): the tokens of each whole text, null
    as empty (no ids). Added tokens' strings in a text become their id. The
    input must not have a column ``ids`` already; it is replaced if so. Rows
    are independent, so repeated rows, ties and extra columns pass through, and
    an empty table gives an empty result. ``path``: a byte-level BPE file that
    every executor can read (default: the public 50k vocabulary)."""
    rows = docs.drop("ids")
    schema = rows.select("*", F.array(F.lit(0)).alias("ids")).schema
    return rows.mapInArrow(_encoder(path or default_path(), column), schema)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` with ``decoded`` (string): the text of the column ``ids``.
    Null ids give an empty text; a column ``decoded`` is replaced."""
    rows = rows.drop("decoded").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    schema = rows.select("*", F.lit("").alias("decoded")).schema
    return rows.mapInArrow(_decoder(path or default_path()), schema)


def round_trip(docs: DataFrame, path: str | None = None, column: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that a task needs one Python
    worker with one vocabulary instead of two."""
    rows = docs.drop("ids", "decoded")
    schema = rows.select("*", F.array(F.lit(0)).alias("ids"), F.lit("").alias("decoded")).schema
    return rows.mapInArrow(_encoder(path or default_path(), column, True), schema)
