"""Token ids packed into rows of fixed length by best-fit decreasing.

A packing group is a run of documents of one partition that together hold
about ``GROUP_TOKENS`` tokens, so packing needs no shuffle and bounded memory.
Inside a group every document longer than a row is split into whole rows and a
rest; rests go, longest first, each to the open row with the least sufficient
space, which a segment tree over the free capacities finds in log2(length)
steps; if none has room a row is opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .textops import slices

CONTEXT = 2048
GROUP_TOKENS = 1 << 22
PADDING = 50256
SCHEMA = ("pack_group long, pack_row int, n_tokens int, input_ids binary, cu_seqlens array<int>, "
          "position_resets array<int>, doc_ids array<long>, doc_offsets array<int>")


class Capacities:
    """Open rows by free space: a segment tree whose leaf c counts the rows
    with c places free."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, free: int, by: int) -> None:
        i = free + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, free: int, row: int) -> None:
        if free:
            self.rows[free].append(row)
            self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free space, row) of an open row with the least space >= need."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):     # up until a right sibling holds rows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        free = i - self.size
        self._add(free, -1)
        return free, self.rows[free].pop()


def best_fit(sizes: list[int], length: int) -> list[int]:
    """The row of each piece (all sizes between 1 and length), longest first,
    ties in the given order."""
    open_rows, where, rows = Capacities(length), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = open_rows.take(sizes[i]) if sizes[i] < length else None     # a whole row fits no open one
        if found is None:
            found, rows = (length, rows), rows + 1
        free, where[i] = found
        open_rows.put(free - sizes[i], where[i])
    return where


def pack(docs: list[tuple[int | None, np.ndarray]], length: int, padding: int) -> Iterator[dict]:
    """Rows of one group."""
    for batch in _lines(docs, length, padding):
        yield from batch.to_pylist()


def _lists(values: np.ndarray | pa.Array, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def id_type(ids: int, padding: int) -> type:
    """The narrowest of uint16 and int32 that holds all ids of the vocabulary and the padding."""
    return np.uint16 if 0 <= padding and max(ids - 1, padding) < 1 << 16 else np.int32


def _lines(docs: list[tuple[int | None, np.ndarray]], length: int, padding: int, kind: type) -> Iterator[pa.RecordBatch]:
    """Rows of one group, some at a time."""
    pieces = [(doc, at, ids[at: at + length]) for doc, ids in docs for at in range(0, len(ids), length)]
    where = np.array(best_fit([len(p[2]) for p in pieces], length), np.int64)
    order = np.argsort(where, kind="stable").tolist()      # pieces by row, in text order inside it
    bounds = np.searchsorted(where[order], np.arange(int(where.max(initial=-1)) + 2))
    for low in range(0, len(bounds) - 1, 2048):
        high = min(low + 2048, len(bounds) - 1)
        some = [pieces[i] for i in order[bounds[low]: bounds[high]]]
        first = bounds[low: high + 1] - bounds[low]        # each row's first piece
        count = np.diff(first)
        sizes = np.array([len(ids) for _, _, ids in some], np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        filled = total[first[1:]] - total[first[:-1]]
        resets = total[:-1] - np.repeat(total[first[:-1]], count)
        lines = np.full((high - low, length), padding, kind)
        lines[np.arange(length)[None, :] < filled[:, None]] = np.concatenate([ids for _, _, ids in some])
        width = lines.itemsize * length
        edges = np.insert(resets, first[1:], filled)       # each row's resets, then its end
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(low, high, dtype=np.int32)), pa.array(filled.astype(np.int32)),
            pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(np.arange(0, (high - low + 1) * width, width, dtype=np.int32)), pa.py_buffer(lines)]),
            _lists(pa.array(edges.astype(np.int32)), first + np.arange(len(first))), _lists(pa.array(resets.astype(np.int32)), first),
            _lists(pa.array([d for d, _, _ in some], pa.int64()), first), _lists(pa.array([at for _, at, _ in some], pa.int32()), first)],
            ["pack_row", "n_tokens", "input_ids", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"])


def _packer(path: str, length: int, group_tokens: int, padding: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab = bpe.vocabulary(path)
        kind = id_type(vocab.ids, padding)
        group, held, tokens = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lines in _lines(held, length, padding, kind):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(lines.num_rows, group)), *lines.columns], ["pack_group", *lines.schema.names])

        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                flat, ends = vocab.encode_batch(t or "" for t in batch.column("text").to_pylist())
                flat = flat.astype(kind)
                for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    held.append((doc, flat[a:b]))
                    tokens += b - a
                    if tokens >= group_tokens:
                        yield from flush()
                        group, held, tokens = group + 1, [], 0
        if held:
            yield from flush()
    return run


def pack_documents(docs: DataFrame, length: int = CONTEXT, path: str | None = None, padding: int = PADDING, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows of the tokens of ``docs`` (doc_id, text): one line of the id
    matrix per row.

    pack_group and pack_row name the line; input_ids is the line itself
    (``length`` little-endian ids, uint16 if all ids of the vocabulary and the
    padding fit, else int32, padded at the end); cu_seqlens are the cumulative segment lengths from 0 to
    n_tokens; position ids restart at 0 at each of position_resets; doc_ids and
    doc_offsets say which document, and from which of its tokens on, each
    segment holds. Every token of every document lies in exactly one segment.

    Null and empty texts have no tokens and so no segment. A null doc_id stays
    null in doc_ids; repeated rows are packed as often as they occur. Other
    columns are ignored; an empty table gives no rows. Groups follow the
    partitions of the input, so the same files pack the same way again."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_packer(path or bpe.default_path(), length, group_tokens, padding), SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet under ``path``."""
    packed.write.mode("overwrite").parquet(path)
