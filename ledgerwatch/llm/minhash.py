"""Near-duplicate documents by fast similarity sketching, banding and exact
verification on full shingle sets.

The sketch (Dahlgaard, Knudsen and Thorup, 2017) has t coordinates, filled in
rounds: in round i < t every shingle is thrown into one hashed bin with a
hashed value that sorts after all values of earlier rounds; in round t + j all
shingles go to bin j. A bin keeps its smallest value, so after 2t rounds every
coordinate is filled whatever the size of the set, and after about one round
for sets larger than t log t. Two sets agree in a coordinate with probability
equal to their Jaccard similarity, with the concentration of independent
minima, at a cost of O(t log t + n) a document instead of O(t n).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .groups import with_groups
from .textops import U64, frugal, mix, seeds, shingle_sets, slices

ROWS = 5             # sketch coordinates per band
MISS = 1e-6          # a pair at the threshold shares no band with at most this probability
BLOCK_SHINGLES = 500_000   # shingles in a block of a large bucket
_VALUE_BITS = U64(48)


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """The bands needed so that a pair at ``similarity`` misses all of them
    with probability at most ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-similarity ** rows))


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a non-empty set of 64-bit fingerprints. Extra
    rounds change nothing (later values sort higher), so small sets throw
    several rounds at a time."""
    out = np.full(t, np.iinfo(np.uint64).max, U64)
    empty, seed = t, seeds(2 * t, 303)
    together = max(1, 512 // len(items))
    for i in range(0, t, together):
        rounds = np.arange(i, min(t, i + together), dtype=U64)[:, None]
        h = mix(items[None, :] ^ seed[i: i + together][: len(rounds), None])
        value = (rounds << _VALUE_BITS) | (h >> U64(16))
        np.minimum.at(out, (mix(h) % U64(t)).ravel().astype(np.int64), value.ravel())
        empty = int(np.count_nonzero(out == np.iinfo(np.uint64).max))
        if not empty:
            break
    if empty:
        for j in np.flatnonzero(out == np.iinfo(np.uint64).max).tolist():
            out[j] = (U64(t + j) << _VALUE_BITS) | (mix(items ^ seed[t + j]).min() >> U64(16))
    return out


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band and document."""
    bands = sketches.reshape(len(sketches), -1, rows)
    keys = (bands * (seeds(rows, 404) | U64(1))).sum(axis=2, dtype=U64)
    return mix(mix(keys) + seeds(bands.shape[1], 505)[None, :])


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sets = shingle_sets(batch.column("text"), k)
                full = [s for s in sets if len(s)]
                keys = band_keys(np.array([sketch(s, bands * rows) for s in full]), rows).view(np.int64) if full else np.zeros((0, bands), np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                first = np.array([s.sum(dtype=U64) if len(s) else 0 for s in sets], U64).view(np.int64)
                second = np.array([mix(s).sum(dtype=U64) if len(s) else 0 for s in sets], U64).view(np.int64)
                ends = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(first), pa.array(second),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    ["doc_id", "n_shingles", "f1", "f2", "bands"])
    return run


SIGNATURE = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"


def signatures(docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """Set size, a 128-bit fingerprint of the shingle set and the band keys of
    every document, read from its whole text in one pass."""
    return docs.select("doc_id", "text").mapInArrow(frugal(_sign(k, bands_for(similarity), ROWS)), SIGNATURE)


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "text_a"):
                for batch in slices(part, "text_b"):
                    left, right = shingle_sets(batch.column("text_a"), k), shingle_sets(batch.column("text_b"), k)
                    ok = []
                    for x, y in zip(left, right):
                        common = len(x) + len(y) - len(np.union1d(x, y))
                        ok.append(bool(len(x)) and 100 * common >= percent * (len(x) + len(y) - common))
                    ok = pa.array(ok, pa.bool_())
                    yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])
    return run


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(frugal(_verify(k, percent)), "a long, b long")


def _linked(xs: list[np.ndarray], ys: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets reach the similarity, as a boolean matrix: exact
    intersection sizes by products of incidence matrices over the fingerprints
    that occur in both lists, some columns at a time."""
    nx, ny = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    all_x, all_y = np.concatenate(xs), np.concatenate(ys)
    shared = np.intersect1d(all_x, all_y)
    common = np.zeros((len(xs), len(ys)), np.float32)
    owner = []
    for flat, sizes in ((all_x, nx), (all_y, ny)):
        at = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        hit = np.flatnonzero(shared[at] == flat) if len(shared) else np.zeros(0, np.int64)
        who, what = np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]
        order = np.argsort(what, kind="stable")
        owner.append((who[order], what[order]))
    for low in range(0, len(shared), 2048):
        sides = []
        for (who, what), n in zip(owner, (len(xs), len(ys))):
            i, j = np.searchsorted(what, [low, low + 2048])
            dense = np.zeros((n, min(2048, len(shared) - low)), np.float32)
            dense[who[i:j], what[i:j] - low] = 1
            sides.append(dense)
        common += sides[0] @ sides[1].T
    return 100 * common.astype(np.int64) >= percent * (nx[:, None] + ny[None, :] - common.astype(np.int64))


def _across_buckets(k: int, percent: int):
    def links(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        ids, comps, apart = (table.column(c).to_numpy() for c in ("doc_id", "component", "apart"))
        xs, ys = np.flatnonzero(apart == 1), np.flatnonzero(apart == 0)
        if len(xs) and len(ys):
            sets = [s for part in table.select(["text"]).to_batches() for batch in slices(part) for s in shingle_sets(batch.column("text"), k)]
            for at in range(0, len(xs), 1024):
                some = xs[at: at + 1024]
                i, j = np.nonzero(_linked([sets[x] for x in some], [sets[y] for y in ys], percent) & (comps[some][:, None] != comps[ys][None, :]))
                if len(i):
                    # one link into each other component suffices for who is reachable
                    _, first = np.unique(np.stack([i, comps[ys][j]]), axis=1, return_index=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some][i[first]]), pa.array(ids[ys][j[first]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            at = 0
            names = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for to in [*cuts.tolist(), batch.num_rows]:
                if to > at:
                    if held and tuple(names[at]) != bucket:
                        yield from links(held)
                        held = []
                    bucket = tuple(names[at])
                    held.append(batch.slice(at, to - at))
                at = to
        if held:
            yield from links(held)
    return run


def _across(named: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between the bucket members that are not yet in their pivot's
    component (x) and the members of other components (y), verified exactly.

    The members of a bucket are dealt into blocks of bounded text and each
    pair of blocks is one unit of work, so a bucket of any size is spread over
    many tasks and no pairs are written, only links."""
    per = F.ceil(F.greatest(F.lit(1), F.col("weight")) / BLOCK_SHINGLES).cast("int")
    total = named.groupBy("key").agg(F.sum("n_shingles").alias("weight"), F.sum(F.expr("if(component <> main, n_shingles, 0)")).alias("of_x")).where("of_x > 0")
    total = total.select("key", per.alias("ny"), F.ceil(F.col("of_x") / BLOCK_SHINGLES).cast("int").alias("nx"))
    active = named.join(total, "key").join(texts, "doc_id")
    row = ["key", "doc_id", "component", "text"]
    x = active.where("component <> main").select(*row, F.lit(1).alias("apart"), F.pmod(F.xxhash64("doc_id"), F.col("nx")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("j"))
    y = active.where("doc_id <> pivot").select(*row, F.lit(0).alias("apart"), F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("i"), F.pmod(F.xxhash64("doc_id"), F.col("ny")).cast("int").alias("j"))
    dealt = x.unionByName(y).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc_id")
    return dealt.select("key", "i", "j", "doc_id", "component", "apart", "text").mapInArrow(frugal(_across_buckets(k, percent)), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of near-duplicate documents (see the module's text).

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for
    their sets of distinct k-word shingles. Returns one row per row of
    ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable
    through links, itself included) and kept (doc_id = component_id).

    - Documents with equal sets collapse to their smallest doc_id first (a
      partial aggregation), so thousands of copies cost one representative.
      Sets that a thousandth of all documents have or more take their class to
      their documents by broadcast, the others by an ordinary join, so no task
      gets all copies of one set.
    - Representatives meet in bands. Each bucket's members are verified against
      its pivot, the member that meets most others; what is then still in
      another component than the pivot is verified against every member of the
      bucket outside its own component. So each pair that meets in a band is
      verified or already connected; none is capped or sampled away. Only
      buckets full of texts that share much yet stay below the threshold need
      many comparisons.
    - A pair at the threshold meets in no band with probability at most 1e-6.

    Null and empty texts and texts of separators only have no shingles and
    link with nothing (kept, component_id = doc_id). Rows without doc_id link
    with nothing, keep a null component_id and stay (kept). Rows that repeat a
    doc_id are one document for linking and each returned. Other columns of
    ``docs`` are ignored. An empty table gives an empty result.
    """
    signed = materialize(signatures(docs, k, percent / 100), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    alike = ["f1", "f2", "n_shingles"]
    sets = materialize(usable.groupBy(*alike).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "sets")
    reps = usable.join(sets.select(*alike, F.col("rep").alias("doc_id")), [*alike, "doc_id"]).dropDuplicates([*alike, "doc_id"])
    rows = reps.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("met")).where("met > 1")
    met = materialize(rows.join(shared, "key"), "met")
    degree = met.groupBy("doc_id").agg(F.sum("met").alias("degree"))
    pivots = met.join(degree, "doc_id").groupBy("key").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("low"))).alias("p")).select("key", (-F.col("p.low")).alias("pivot"))
    met = materialize(met.join(pivots, "key").select("key", "doc_id", "n_shingles", "pivot"), "met")
    texts = materialize(docs.select("doc_id", "text").join(met.select("doc_id").distinct(), "doc_id", "left_semi"), "texts")

    low, high = F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")
    first = met.where("doc_id <> pivot").select(low, high).distinct()
    links = materialize(verify(first, texts, k, percent), "linked")
    found = materialize(components(links), "found")

    named = met.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    main = found.select(F.col("node").alias("pivot"), F.col("component").alias("main"))
    named = materialize(named.join(main, "pivot", "left").withColumn("main", F.coalesce("main", "pivot")), "named")
    further = materialize(_across(named, texts, k, percent), "further")
    if not further.isEmpty():
        found = materialize(components(links.unionByName(further)), "found")

    classes = materialize(sets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        *alike, "copies", F.coalesce("component", "rep").alias("component_id")), "classes")
    grouped = with_groups(usable.select("doc_id", *alike), classes, alike).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
