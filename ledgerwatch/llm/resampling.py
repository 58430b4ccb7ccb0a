"""Importance resampling towards a target distribution over hashed n-grams.

A document's features are its runs of one to ``n`` consecutive words; a
feature's bucket is the CRC-32 of its bytes modulo the number of buckets.
Feature counts of the documents and of the target give every bucket a log
ratio (gain); a document's weight is the mean gain of its features, and Gumbel
noise from its id turns the highest scores into a draw without replacement.

CRC-32 is affine over XOR: the checksum of a span is a constant of its length
XOR one contribution per byte, which depends on the byte and its distance from
the span's end. A table of those contributions turns all features of a buffer
into one gather and one ``bitwise_xor.reduceat``. Spans longer than the table
are cut into blocks counted from their end; a block's checksum is advanced over
the blocks behind it by linear maps for powers of two, then all are XORed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textops import _LOWER, buffers, slices, word_spans

BUCKETS = 10_000
NGRAM = 2
LEAST_WORDS = 20          # documents with fewer words aren't drawn
PERCENT = 25              # of the documents with enough words
SEED = 7
REACH_BITS = 7
REACH = 1 << REACH_BITS   # distances from the end in the table
PIECE = 1 << 20           # bytes of text worked on at a time

U32 = np.uint32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=U32)
    for _ in range(8):
        out = (out >> U32(1)) ^ (U32(0xEDB88320) * (out & U32(1)))
    return out


_FIRST = _byte_table()


def _positions() -> np.ndarray:
    """Contribution of a byte by its distance from the end, flat."""
    rows = [_FIRST]
    while len(rows) < REACH:
        rows.append((rows[-1] >> U32(8)) ^ _FIRST[rows[-1] & U32(255)])
    return np.concatenate(rows)


_POSITIONS = _positions()


def _advancers() -> list[np.ndarray]:
    """For each k the linear map of 2**k zero bytes on the register, as a table
    for each of its four bytes."""
    base = np.arange(256, dtype=U32)[None, :] << (U32(8) * np.arange(4, dtype=U32)[:, None])
    out = [(base >> U32(8)) ^ _FIRST[base & U32(255)]]
    while len(out) < 40:
        out.append(_apply(out[-1], out[-1]))
    return out


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & U32(255)] ^ tables[1][(x >> U32(8)) & U32(255)] ^ tables[2][(x >> U32(16)) & U32(255)] ^ tables[3][x >> U32(24)]


_ADVANCE = _advancers()


def advance(register: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The registers after ``size`` further zero bytes each."""
    out = register.copy()
    for k in range(int(size.max(initial=0)).bit_length()):
        on = np.flatnonzero((size >> k) & 1)
        out[on] = _apply(_ADVANCE[k], out[on])
    return out


def length_constants(size: np.ndarray) -> np.ndarray:
    """The checksums of ``size`` zero bytes."""
    full = np.full(len(size), 0xFFFFFFFF, U32)
    return advance(full, size) ^ full


_CONSTANTS = length_constants(np.arange(8 * REACH))


def registers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The XOR of the contributions of data[start, end) for non-empty spans in
    order that don't overlap; a byte follows the last span."""
    low, size = int(start[0]), end - start
    blocks = -(-size // REACH)
    many = int(blocks.max()) > 1
    if many:
        head = np.cumsum(blocks) - blocks
        behind = np.repeat(blocks + head, blocks) - 1 - np.arange(int(blocks.sum()))       # blocks between a block and its span's end
        stop = np.repeat(end, blocks) - behind * REACH
        begin = np.maximum(np.repeat(start, blocks), stop - REACH)
    else:
        begin, stop = start, end
    part = data[low: int(end[-1]) + 1]
    width = np.diff(np.append(begin, end[-1] + 1))
    distance = np.repeat(stop - low - 1, width) - np.arange(len(part))
    part_of = _POSITIONS[((distance & (REACH - 1)) << 8) | part]       # bytes between spans are read and left out
    bounds = np.stack([begin - low, stop - low], axis=1).ravel()
    out = np.bitwise_xor.reduceat(part_of, bounds)[::2]
    if many:
        out = np.bitwise_xor.reduceat(advance(out, behind * REACH), head)
    return out


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The unsigned CRC-32 of data[start, end) of each span (see ``registers``)."""
    out, at = np.empty(len(start), U32), 0
    while at < len(start):
        to = int(np.searchsorted(end, start[at] + PIECE, "right"))
        if to > at:
            out[at:to] = registers(data, start[at:to], end[at:to])
        else:                       # one span longer than a piece folds piece by piece
            to, state = at + 1, np.zeros(1, U32)
            for low in range(int(start[at]), int(end[at]), PIECE):
                high = min(int(end[at]), low + PIECE)
                state = advance(state, np.array([high - low])) ^ registers(data, np.array([low]), np.array([high]))
            out[at] = state[0]
        at = to
    size = end - start
    short = size < len(_CONSTANTS)
    out[short] ^= _CONSTANTS[size[short]]
    out[~short] ^= length_constants(size[~short])
    return out


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first row, lower-cased bytes, row offsets, carried) of runs of rows of
    about PIECE bytes; a longer text comes in pieces cut between words, each
    (but the first) led by the last word of the one before (carried)."""
    row = 0
    for part in slices(batch, "text", PIECE):
        raw, offsets = buffers(part.column("text"))
        if part.num_rows > 1 or len(raw) <= 2 * PIECE:
            yield row, _LOWER[raw], offsets, False
        else:
            at, to, carried = 0, 0, False
            while to < len(raw):
                to = min(len(raw), to + PIECE)
                while to < len(raw) and _WORD[_LOWER[raw[to]]]:        # to the end of the word
                    rest = np.flatnonzero(~_WORD[_LOWER[raw[to: to + PIECE]]])
                    to = to + int(rest[0]) if len(rest) else min(len(raw), to + PIECE)
                low = _LOWER[raw[at:to]]
                yield row, low, np.array([0, len(low)]), carried
                start, _ = word_spans(low, np.array([0, len(low)]), _WORD)
                at, carried = (at + int(start[-1]), True) if len(start) else (to, False)
        row += part.num_rows


def features(low: np.ndarray, offsets: np.ndarray, carried: bool, buckets: int = BUCKETS, ngram: int = NGRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, row of each, words per row) of a piece; a carried first word
    only counts where it begins a longer run."""
    start, end = word_spans(low, offsets, _WORD)
    words = np.diff(np.searchsorted(start, offsets))
    row = np.repeat(np.arange(len(words)), words)
    if not len(start):
        return np.zeros(0, np.int64), row, words
    size = end - start
    data = np.full(int(size.sum()) + len(size), 32, np.uint8)          # words with one space after each
    begin = np.cumsum(size + 1) - size - 1
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    data[np.repeat(begin, size) + inside] = low[np.repeat(start, size) + inside]
    marks, rows = [], []
    for n in range(1, ngram + 1):
        first = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1:])      # runs of n words in one row
        if carried and n == 1:
            first = first[1:]
        for turn in range(n):                                               # runs that don't overlap
            some = first[first % n == turn]
            if len(some):
                marks.append(crc32_spans(data, begin[some], begin[some + n - 1] + size[some + n - 1]))
                rows.append(row[some])
    if carried:
        words = words - (np.arange(len(words)) == 0)
    if not marks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words
    return np.concatenate(marks).astype(np.int64) % buckets, np.concatenate(rows), words


def _count(buckets: int, ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, low, offsets, carried in _pieces(batch):
                total += np.bincount(features(low, offsets, carried, buckets, ngram)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, ngram: int = NGRAM) -> DataFrame:
    """(bucket, n) over all rows of ``texts`` (text): one row per used bucket,
    at most ``buckets``. Every task sends its sums only."""
    counted = texts.select("text").mapInArrow(_count(buckets, ngram), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, ngram: int = NGRAM) -> np.ndarray:
    """Thousandths of the log ratio of target to documents, by bucket. The two
    count tables have at most ``buckets`` rows each, which reach the driver."""
    both = bucket_counts(docs, buckets, ngram).withColumn("side", F.lit(0)).unionByName(bucket_counts(target, buckets, ngram).withColumn("side", F.lit(1)))
    n = np.zeros((2, buckets))
    for r in both.collect():
        n[r["side"], r["bucket"]] = r["n"]
    s, t = n
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weigh(shared, buckets: int, ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            total, count, words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, low, offsets, carried in _pieces(batch):
                bucket, owner, per_row = features(low, offsets, carried, buckets, ngram)
                span = slice(row, row + len(per_row))
                words[span] += per_row
                count[span] += np.bincount(owner, minlength=len(per_row))
                total[span] += np.bincount(owner, gain[bucket], len(per_row)).astype(np.int64)       # sums below 2**53 are exact
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(count), pa.array(weight), batch.column("mark")], ["doc_id", "words", "n_features", "weight", "mark"])
    return run


def noise(seed: int, column: str = "doc_id") -> Column:
    """Thousandths of Gumbel noise from the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             ngram: int = NGRAM, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight,
    score, rank.

    Features and counts cover all rows and whole texts of ``docs`` and
    ``target`` (text), A-Z lower-cased; null and empty texts have no features
    and weight 0. Of the N documents with at least ``least_words`` words the
    floor(percent * N / 100) with the highest scores are drawn and numbered in
    that order; rank is null for the others. Ties go to the smaller doc_id, a
    null doc_id first (its noise is that of an empty id), then by a hash of the
    text; rows alike in all of these are interchangeable. Repeated rows are
    documents like others. Other columns are ignored. An empty ``docs`` gives an
    empty result; an empty ``target`` leaves all its counts 0.

    Scores are whole thousandths, so a table of counts by score (some tens of
    thousands of rows whatever the number of documents) tells the score that
    the draw ends in. Only rows from it upwards are range-sorted; a rank is the
    rows in earlier ranges plus the place inside its own."""
    shared = docs.sparkSession.sparkContext.broadcast(gains(docs, target, buckets, ngram))
    weighed = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("mark")).mapInArrow(
        _weigh(shared, buckets, ngram), f"doc_id {dict(docs.dtypes)['doc_id']}, words long, n_features long, weight long, mark long")
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("able", F.col("words") >= least_words), "scored")

    # the lowest score with a drawn row, and how many are drawn
    hist = scored.where("able").groupBy("score").agg(F.count("*").alias("n"))
    rows = hist.selectExpr("score", "n", "sum(n) over (order by score desc) as upto", "floor(sum(n) over () * %d / 100) as drawn" % percent)
    cut = rows.where("upto - n < drawn").agg(F.min("score").alias("least"), F.max("drawn").alias("drawn")).first()
    columns = ["doc_id", "n_features", "weight", "score"]
    if not cut["drawn"]:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    taken = F.col("able") & (F.col("score") >= cut["least"])
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "mark", "weight", "n_features", "spread"]
    ranged = scored.where(taken).withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    spot = F.monotonically_increasing_id()
    ranged = materialize(ranged.select(*columns, F.shiftright(spot, 33).alias("range"), spot.bitwiseAND((1 << 33) - 1).alias("place")), "ranged")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))              # one row per shuffle partition
    before = sizes.selectExpr("range", "coalesce(sum(n) over (order by range rows between unbounded preceding and 1 preceding), 0) as before")
    rank = F.col("before") + F.col("place") + 1
    ranked = ranged.join(F.broadcast(before), "range").select(*columns, F.when(rank <= cut["drawn"], rank).alias("rank"))
    return ranked.unionByName(scored.where(~taken).select(*columns, F.lit(None).cast("long").alias("rank")))


ORACLE = r"""with recursive steps as (
  select i, i as c, 0 as n from range(256) r(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n + 1 from steps where n < 8),
tab as (
  select list(c order by i) as t from steps where n = 8),
texts as (
  select 'd' as side, row_number() over () as id, doc_id, text from documents
  union all select 't', row_number() over (), null, text from benchmark),
w as (
  select side, id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from texts),
f as (
  select side, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as feature from w),
counted as (
  select side, id, feature, count(*) as n from f group by all),
named as (
  select feature, hex(encode(feature)) as h from (select distinct feature from counted)),
bucketed as (
  select feature, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(0, len(h) // 2),
    lambda i: ((strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from named, tab),
placed as (
  select side, id, bucket, sum(n) as n from counted join bucketed using (feature) group by all),
sums as (
  select bucket, coalesce(sum(n) filter (where side = 'd'), 0)::double as s, coalesce(sum(n) filter (where side = 't'), 0)::double as t from placed group by bucket),
gain as (
  select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from sums) + 10000) / ((s + 1) * ((select sum(t) from sums) + 10000)))) as g from sums),
doc as (
  select id, sum(n)::bigint as n_features, floor(sum(n * g) / sum(n))::bigint as weight from placed join gain using (bucket) where side = 'd' group by id),
scored as (
  select w.doc_id, len(ws) as words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(w.doc_id::varchar, '')), 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score
  from w left join doc using (id) where side = 'd'),
ranked as (
  select *, row_number() over (partition by words >= 20 order by score desc, doc_id nulls first) as place, count(*) filter (where words >= 20) over () as able from scored)
select doc_id, n_features, weight, score, case when words >= 20 and place <= able * 25 // 100 then place end as rank from ranked"""
