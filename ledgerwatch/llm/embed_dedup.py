"""Near-duplicate embeddings: one HNSW graph per shard, every vector searched
in every shard, links verified in double precision and united."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .groups import with_groups
from .hnsw import Graph
from .textops import mix

SHARD_ROWS = 65_536     # vectors in a shard at most (on average)
MIN_SHARDS = 6          # shards of a small table
SLICE_ROWS = 1 << 20    # vectors searched in one task's shard at most (on average)
AUDITED = 1_024         # vectors of each length whose links are also found by brute force in every shard
RECALL = 0.999          # share of them whose links the graph must find, all of each
BEAM = 32               # first beam
SLACK = 1e-4            # single-precision similarities this far below are verified


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors, each times the power of two that brings its largest
    component near 1: cosines stay, squares neither over- nor underflow."""
    if vectors.dtype.kind != "f":
        vectors = vectors.astype(np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


class Shard:
    """The graph over one shard's vectors, and who is linked inside it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, threshold: float):
        order = np.argsort(mix(ids.view(np.uint64)), kind="stable")       # insertion in hashed order
        self.ids, self.copies, self.threshold = ids[order], copies[order], threshold
        self.vectors = vectors[order]          # scaled, as all vectors here
        self.norm = norms(self.vectors)
        unit = (self.vectors / self.norm[:, None]).astype(np.float32)
        draw = (mix(mix(self.ids.view(np.uint64))) >> np.uint64(11)) / float(1 << 53)
        self.graph = Graph(unit, np.floor(-np.log(np.maximum(draw, 1e-12)) / math.log(12)).astype(np.int64))
        self.beam = BEAM
        self.label = np.arange(len(ids))

    def links(self, vectors: np.ndarray, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query row, shard row) of all links found. A beam whose worst entry
        is still linked was too narrow for that query and doubles."""
        norm = norms(vectors)
        unit = (vectors / norm[:, None]).astype(np.float32)
        beam = min(beam or self.beam, len(self.ids))
        todo, found = np.arange(len(vectors)), []
        while len(todo):
            narrow, step = [], max(8, (1 << 14) // beam)
            for at in range(0, len(todo), step):
                rows = todo[at: at + step]
                near, sims = self.graph.search(unit[rows], beam)
                again = (sims[:, -1] >= self.threshold - SLACK) & (beam < len(self.ids))
                narrow.append(rows[again])
                r, c = np.nonzero((sims >= self.threshold - SLACK) & ~again[:, None])
                a, b = rows[r], near[r, c]
                for low in range(0, len(a), 1 << 16):
                    i, j = a[low: low + (1 << 16)], b[low: low + (1 << 16)]
                    dot = np.einsum("ij,ij->i", vectors[i].astype(np.float64), self.vectors[j].astype(np.float64))
                    ok = dot / (norm[i] * self.norm[j]) >= self.threshold
                    found.append((i[ok], j[ok]))
            todo, beam = np.concatenate(narrow), min(2 * beam, len(self.ids))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])

    def exact_links(self, vectors: np.ndarray) -> np.ndarray:
        """The number of links of each vector."""
        total, norm = np.zeros(len(vectors), np.int64), norms(vectors)
        for at in range(0, len(self.ids), 4096):
            part = self.vectors[at: at + 4096].astype(np.float64) / self.norm[at: at + 4096, None]
            total += np.count_nonzero(part @ (vectors.astype(np.float64) / norm[:, None]).T >= self.threshold, axis=0)
        return total

    def audit(self, vectors: np.ndarray) -> None:
        """Widen the first beam until a share of RECALL of the audited vectors
        that have links have all of them found."""
        true = self.exact_links(vectors)
        linked = np.count_nonzero(true)
        while linked and self.beam < len(self.ids):
            found = np.bincount(self.links(vectors)[0], minlength=len(vectors))
            if np.count_nonzero((true > 0) & (found >= true)) >= RECALL * linked:
                break
            self.beam *= 2

    def join_inside(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links among the shard's own vectors: unites them and yields (row,
        copies linked) some rows at a time, keeping no pairs."""
        for at in range(0, len(self.ids), 1024):
            i, j = self.links(self.vectors[at: at + 1024])
            i = i + at
            keep = i != j
            i, j = i[keep], j[keep]
            a, b = self.label[i], self.label[j]
            while len(a):
                low = np.minimum(a, b)
                np.minimum.at(self.label, a, low)
                np.minimum.at(self.label, b, low)
                while (self.label[self.label] != self.label).any():
                    self.label = self.label[self.label]
                a, b = self.label[a], self.label[b]
                a, b = a[a != b], b[a != b]
            rows, where = np.unique(i, return_inverse=True)
            yield rows, np.bincount(where, self.copies[j], len(rows)).astype(np.int64)


def _names(shard: Shard) -> np.ndarray:
    """Each row's component inside the shard, by its smallest vec_id."""
    least = shard.ids.copy()
    np.minimum.at(least, shard.label, shard.ids)
    return least[shard.label]


def _work(threshold: float):
    def out(ids, other, links) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(other, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])

    def vectors(column: pa.Array) -> np.ndarray:
        return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition's rows come sorted by (dim, shard, slice, kind): first
        the shard's vectors (0), then audited ones (1), then all vectors of the
        slice (2), which stream through. Every slice builds the shard's graph,
        the same each time; the first one returns the links inside the shard."""
        key, held, shard, name, audited = None, [], None, None, []

        def open_shard() -> Iterator[pa.RecordBatch]:
            nonlocal shard, name, held, audited
            table = pa.Table.from_batches(held)
            shard = Shard(table.column("id").to_numpy(), np.concatenate([vectors(b.column("vector")) for b in held]), table.column("copies").to_numpy(), threshold)
            if audited:
                shard.audit(np.concatenate(audited))
            inside = list(shard.join_inside())
            name = _names(shard)
            for rows, links in inside if key[2] == 0 else []:
                yield out(shard.ids[rows], name[rows], links)
            held, audited = [], []

        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "slice", "kind")], axis=1)
            cuts = [*(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            at = 0
            for to in cuts:
                if to == at:
                    continue
                part, (*unit, kind) = batch.slice(at, to - at), marks[at].tolist()
                at = to
                if key != unit:
                    key, held, shard, audited = unit, [], None, []
                if kind == 0:
                    held.append(part)
                elif kind == 1:
                    audited.append(vectors(part.column("vector")))
                else:
                    if shard is None:
                        if not held:           # no vectors were dealt to this shard
                            continue
                        yield from open_shard()
                    ids, q = part.column("id").to_numpy(), vectors(part.column("vector"))
                    foreign = np.flatnonzero(~np.isin(ids, shard.ids))     # its own vectors are done
                    for low in range(0, len(foreign), 1024):
                        rows = foreign[low: low + 1024]
                        i, j = shard.links(q[rows])
                        if len(i):
                            # one row per query and component inside the shard
                            pair, where = np.unique(np.stack([i, name[j]]), axis=1, return_inverse=True)
                            yield out(ids[rows][pair[0]], pair[1], np.bincount(where.ravel(), shard.copies[j], pair.shape[1]).astype(np.int64))
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors with
    cosine at least ``threshold``, computed in double precision), component_id
    (smallest vec_id reachable, itself included), kept (vec_id = component_id).

    - Equal vectors collapse to one with a count first, so copies are never
      expanded into pairs. Vectors that a thousandth of all rows have or more
      take their result to their rows by broadcast.
    - Shards are dealt by hash; their number follows the table, so a shard's
      graph has bounded size. Every vector is sent to every shard and streams
      past its graph, a bounded slice of all vectors in a task, so a task's
      time doesn't grow with the table. Beams double for a query whose beam is full of links, and
      for the shard until all links of 99.9 % of the audited vectors (a fixed
      number of each length, searched by brute force as well) are found.
    - A shard returns one row per query and component inside the shard, with
      the number of vectors linked, so a tight cluster yields no quadratic
      output. Links below the threshold never pass; links can only be missed,
      at the recall audited.

    Null, empty and zero vectors and ones with null or non-finite components
    link with nothing, nor do vectors of different lengths with each other.
    Rows without vec_id link with nothing and stay (component_id null). Rows
    that repeat a vec_id are vectors of their own (equal ones link). Other
    columns, whatever their names, are ignored. Empty tables give empty results.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    good = rows.where(usable)
    distinct = good.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")).sortWithinPartitions("least", "vector")
    # from here on a vector goes by a number of its own, as vec_ids may repeat
    distinct = materialize(distinct.select(F.monotonically_increasing_id().alias("id"), "least", "copies", F.size("vector").alias("dim"), "vector"), "vectors")
    shards = max(MIN_SHARDS, math.ceil(distinct.count() / SHARD_ROWS))
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id"))       # the first of each length, picked before the shuffle
    audited = distinct.withColumn("place", place).where(F.col("place") <= AUDITED)
    slices = max(1, math.ceil(distinct.count() / SLICE_ROWS))
    units = shards * slices
    of_id, every = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int"), lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    graph = distinct.withColumn("shard", of_id(shards, 1)).withColumn("slice", F.explode(every(slices))).withColumn("kind", F.lit(0))
    checks = audited.withColumn("shard", F.explode(every(shards))).withColumn("slice", F.explode(every(slices))).withColumn("kind", F.lit(1))
    queries = distinct.withColumn("shard", F.explode(every(shards))).withColumn("slice", of_id(slices, 2)).withColumn("kind", F.lit(2))
    dealt = graph.unionByName(checks.drop("place")).unionByName(queries).drop("least")
    # each (shard, slice) of one length gets a task of its own
    task = F.pmod(F.pmod(F.xxhash64("dim"), F.lit(units)) + F.col("shard") * slices + F.col("slice"), F.lit(units)).cast("int")
    dealt = dealt.repartitionById(units, task).sortWithinPartitions("dim", "shard", "slice", "kind", "id")
    links = materialize(dealt.mapInArrow(_work(threshold), "a long, b long, links long"), "links")
    found = components(links.select("a", "b")).select(F.col("node").alias("id"), "component")
    members = materialize(found.join(distinct.select("id", "least"), "id"), "members")
    united = materialize(members.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("copies")), "united")
    counted = links.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    values = distinct.select("id", "least", "copies").join(counted, "id", "left").join(with_groups(members.select("id", "component"), united, ["component"]).select("id", "component_id"), "id", "left")
    values = materialize(values.select("id", "least", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("component_id", "least").alias("component_id")), "values")
    copied = materialize(distinct.where("copies > 1").select("id", "vector").join(values, "id").select("vector", "copies", "n_links", "component_id"), "copied")
    result = with_groups(good, copied, ["vector"]).select("vec_id", "n_links", "component_id").unionByName(
        values.where("copies = 1").select(F.col("least").alias("vec_id"), "n_links", "component_id"))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
