"""Word and shingle fingerprints of whole texts, vectorised over Arrow buffers.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, after
lower-casing A-Z. All separators are ASCII, so working on UTF-8 bytes gives
the same words as working on code points. Every word gets a 64-bit
fingerprint from prefix sums of a byte polynomial (a handful of NumPy passes
over the buffer, no per-word Python), and a k-word shingle mixes the
fingerprints of its words. Two different shingles share a fingerprint with
probability about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])
CHUNK = 1 << 18            # bytes hashed at a time
SLICE_BYTES = 2 << 20      # bytes of text handled at a time inside an Arrow batch

U64 = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SEPARATORS)] = False


def give_back() -> None:
    """Return freed memory to the system. Spark reuses Python workers for the
    tasks of later stages, so what a partition needed is given back at its end."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:      # a C library without it
        pass


def frugal(run):
    """``run`` over a partition's batches, giving memory back at the end."""
    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return through


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed 64-bit seeds."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt))


_BYTE = seeds(256, 17)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept for reuse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK)
        up, down = np.full(size, _BASE, U64), np.full(size, _INVERSE, U64)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


def prefix_sums(low: np.ndarray) -> np.ndarray:
    """Prefix sums P of the byte polynomial, so that bytes [i, j) have the
    position-free fingerprint ``(P[j] - P[i]) * base**-i``."""
    up, _ = powers(len(low) + 1)
    out = np.zeros(len(low) + 1, U64)
    np.cumsum(_BYTE[low] * up[: len(low)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts stay near ``limit`` bytes (one row at least)."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def word_spans(raw: np.ndarray, offsets: np.ndarray, member: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a row's end always ends a word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = member[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(raw)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[1:]
    cut = cut[cut > 0] - 1
    last[cut] = inside[cut]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, start bytes, end bytes, words per row), hashing the
    buffer in chunks cut between words so that memory stays bounded."""
    start, end = word_spans(raw, offsets)
    out = np.empty(len(start), U64)
    at = 0
    while at < len(start):
        base = start[at]
        to = max(at + 1, int(np.searchsorted(end, base + CHUNK, "right")))
        prefix = prefix_sums(_LOWER[raw[base: end[to - 1]]])
        out[at:to] = span_hash(prefix, start[at:to] - base, end[at:to] - base)
        at = to
    counts = np.diff(np.searchsorted(start, offsets))
    return out, start, end, counts


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each row's k-word shingles in text order, with the
    number of them per row. A row with 1..k-1 words has its whole sequence as
    its one shingle; a row without words has none."""
    n = len(words)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    factor = seeds(k, 101) | U64(1)
    rolled = np.zeros(n, U64)
    for j in range(min(k, n)):
        rolled[: n - j] += words[j:] * factor[j]
    rolled = mix(rolled)
    keep = np.ones(n, bool)
    for j in range(1, k):                      # the last k-1 words of a row begin no shingle
        tail = first + counts - j
        keep[tail[tail >= first]] = False
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        part = words[first[row]: first[row] + counts[row]]
        rolled[first[row]] = mix(np.array([np.sum(part * factor[: len(part)], dtype=U64) + U64(len(part))], U64))[0]
        keep[first[row]] = True
    return rolled[keep], np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle fingerprints of each row."""
    raw, offsets = buffers(column)
    words, _, _, counts = word_hashes(raw, offsets)
    marks, sizes = shingles(words, counts, k)
    out, at = [], 0
    for n in sizes.tolist():
        part = np.sort(marks[at: at + n])
        if n > 1:
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        out.append(part)
        at += n
    return out
