"""M7: exact path-dependent tree attribution (TreeSHAP values) of a Spark
random forest, for any number of rows.

A leaf is a box: an interval per feature, from the thresholds on its path, and
per feature the share of training weight that follows the path at that
feature's splits. A row's attribution at a leaf is a Shapley value over which
features are known; written as an integral over the share t of known features,

    phi_f = value * (in_f - share_f) * integral prod_{j != f} (share_j (1 - t) + in_j t) dt,

with in_j = 1 where the row's value lies in the leaf's interval. The integrand
is a polynomial of lower degree than there are features, so a few Gauss-Legendre
points give it exactly. It depends on the row only by which features of the
leaf's path are inside, so a leaf has a table of at most 2^features parts. The
leaves below one node share most of their bounds: their tables are added up
over the cells of the thresholds they have between them, and a row looks up one
cell for all of them. Rows in one cell of a whole tree's thresholds are looked
up once.

The leaves of the forest are broadcast, in groups of bounded size, and rows are
explained where they lie: the work is parallel over rows and no row reaches the
driver. Sum of phi + base value = the forest's class-1 probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

GROUP_LEAVES = 1 << 17       # leaves broadcast together (about 150 bytes each per feature)
CELLS = 1 << 18              # (leaf, pattern, feature) cells of tables held at a time
ROWS = 1 << 17               # rows explained together
LEAVES = 64                  # leaves whose tables are added up at most
JOINED = 1 << 12             # bins of features that are looked up together
SHARE = 8                    # rows to a cell of such a sum at least


def _tree_arrays(pdf: pd.DataFrame):
    pdf = pdf.sort_values("id")
    n = int(pdf["id"].max()) + 1
    left = np.full(n, -1, dtype=np.int64)
    right = np.full(n, -1, dtype=np.int64)
    feat = np.full(n, -1, dtype=np.int64)
    thr = np.zeros(n)
    cover = np.zeros(n)
    value = np.zeros(n)
    for r in pdf.itertuples(index=False):
        i = int(r.id)
        stats = np.asarray(r.impurityStats, dtype=float)
        tot = float(stats.sum())
        left[i], right[i], feat[i] = int(r.leftChild), int(r.rightChild), int(r.featureIndex)
        thr[i] = float(r.threshold) if r.threshold is not None and not pd.isna(r.threshold) else 0.0
        cover[i] = tot
        value[i] = stats[1] / tot if tot > 0 and len(stats) > 1 else 0.0
    return left, right, feat, thr, cover, value


class Leaves:
    """The leaves of one tree: bounds and shares by feature, and values."""

    def __init__(self, left, right, feat, thr, cover, value, features: int):
        rows, spans = [], []          # of each node: its first leaf, the one after its last, its children's places here or -1

        def walk(j: int, low: np.ndarray, high: np.ndarray, share: np.ndarray) -> int:
            place, children = len(spans), []
            spans.append((len(rows), len(rows) + 1, -1, -1))
            if left[j] < 0:
                rows.append((low, high, share, value[j], cover[j] / cover[0] if cover[0] > 0 else 0.0))
                return place
            f = feat[j]
            for child, below in ((left[j], True), (right[j], False)):
                lo, hi, part = low.copy(), high.copy(), share.copy()
                if below:
                    hi[f] = min(hi[f], thr[j])
                else:
                    lo[f] = max(lo[f], thr[j])
                part[f] *= cover[child] / cover[j] if cover[j] > 0 else 0.0
                children.append(walk(child, lo, hi, part))
            spans[place] = (spans[place][0], len(rows), *children)
            return place

        walk(0, np.full(features, -np.inf), np.full(features, np.inf), np.ones(features))
        self.low, self.high, self.share, self.value, weight = (np.array(x) for x in zip(*rows))
        self.expected = float((weight * self.value).sum())

        # per feature: thresholds, and by leaf the first and last bin between them that lies inside
        self.cuts, self.first, self.last = [], np.zeros(self.low.shape, np.int64), np.zeros(self.low.shape, np.int64)
        for f in range(features):
            low, high = self.low[:, f], self.high[:, f]
            cuts = np.unique(np.concatenate([low[np.isfinite(low)], high[np.isfinite(high)]]))
            self.cuts.append(cuts)
            self.first[:, f] = np.where(np.isneginf(low), 0, np.searchsorted(cuts, low) + 1)
            self.last[:, f] = np.where(np.isposinf(high), len(cuts), np.searchsorted(cuts, high))
        self.split = ~np.isneginf(self.low) | ~np.isposinf(self.high)       # features on a leaf's path
        self.bit = self.split.cumsum(axis=1) - 1
        self.spans, self.cells = np.array(spans), self._cells(spans)

    def _cells(self, spans: list[tuple[int, int, int, int]]) -> np.ndarray:
        """Of each node, how many cells ``edges`` of its leaves cut the features into."""
        bounds = np.where(self.split[:, :, None], np.stack([self.first, self.last + 1], axis=2), -1).tolist()
        masks, cells = {}, np.ones(len(spans))
        for place in range(len(spans) - 1, -1, -1):
            a, _, below, above = spans[place]
            if below < 0:
                masks[place] = [1 << x | 1 << y if x >= 0 else 1 for x, y in bounds[a]]
            else:
                # a feature on some path only has bin 0 as its edge elsewhere, which edges() leaves out
                masks[place] = [x if y == 1 else y if x == 1 else x | y for x, y in zip(masks.pop(below), masks.pop(above))]
            cells[place] = math.prod(float(m.bit_count()) for m in masks[place])
        return cells

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Of each value, the interval between thresholds of the tree; a missing
        value goes right, as in the forest."""
        return np.stack([np.searchsorted(cuts, x[:, f]) for f, cuts in enumerate(self.cuts)], axis=1)

    def tables(self, leaves: np.ndarray) -> np.ndarray:
        """[leaf, which features of its path are inside (bits), feature of its
        path]: the attribution at leaves whose paths have equally many features."""
        k = int(self.split[leaves[0]].sum())
        share = self.share[leaves][self.split[leaves]].reshape(len(leaves), 1, k)
        inside = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(float)[None]
        push = inside - share
        points, weights = np.polynomial.legendre.leggauss(max(1, -(-k // 2)))
        out = np.zeros(push.shape)
        for t, w in zip((points + 1) / 2, weights / 2):
            factor = share * (1 - t) + inside * t
            # shares of 0 come from splits that no training weight passed; keep the division defined
            safe = np.where(factor > 0, factor, 1e-300)
            out += (safe.prod(axis=2) * (w * self.value[leaves])[:, None])[:, :, None] * push / safe
        return out

    def parts(self, at: int, to: int) -> tuple[np.ndarray, np.ndarray]:
        """The tables of leaves ``at`` to ``to`` below each other, by feature,
        and where each leaf's begins."""
        used = self.split[at:to].sum(axis=1)
        begin = np.concatenate([[0], np.cumsum(1 << used)])
        out = np.zeros((begin[-1], self.split.shape[1]))
        for k in np.unique(used[used > 0]).tolist():
            alike = np.flatnonzero(used == k)
            path = np.nonzero(self.split[at + alike])[1].reshape(-1, 1, k)
            out[(begin[alike][:, None] + np.arange(1 << k))[:, :, None], path] = self.tables(at + alike)
        return out, begin

    def joined(self) -> list[list[int]]:
        """The features in groups with at most JOINED cells between them."""
        groups, size = [], JOINED + 1
        for f, cuts in enumerate(self.cuts):
            if size * (len(cuts) + 1) > JOINED:
                groups.append([])
                size = 1
            groups[-1].append(f)
            size *= len(cuts) + 1
        return groups

    def edges(self, a: int, b: int) -> list[np.ndarray]:
        """By feature, the bins where one of the leaves ``a`` to ``b`` with the
        feature on its path begins or has ended; bin 0 where there is none."""
        out = []
        for f in range(self.split.shape[1]):
            on = np.flatnonzero(self.split[a:b, f]) + a
            out.append(np.unique(np.concatenate([self.first[on, f], self.last[on, f] + 1])) if len(on) else np.zeros(1, np.int64))
        return out

    def blocks(self, cells: int) -> Iterator[tuple[int, int]]:
        """(first leaf, the one after the last) of runs of leaves below one
        node, as long as their edges cut the features into at most ``cells``
        cells."""
        stack = [0]
        while stack:
            place = stack.pop()
            a, b, below, above = self.spans[place].tolist()
            if below < 0 or b - a <= LEAVES and self.cells[place] <= cells:
                yield a, b
            else:
                stack += above, below

    def lots(self, cells: int) -> Iterator[list[tuple[int, int]]]:
        """The blocks, as many together as have CELLS cells in their leaves' tables."""
        lot, held, used = [], 0, self.split.sum(axis=1)
        for block in self.blocks(cells):
            size = int((used[block[0]: block[1]] << used[block[0]: block[1]]).sum())
            if lot and held + size > CELLS:
                yield lot
                lot, held = [], 0
            lot.append(block)
            held += size
        yield lot

    def phi(self, x: np.ndarray) -> np.ndarray:
        """A leaf's part depends only on which features of its path are inside
        its interval, so the parts of a block of leaves are summed for each
        cell between their edges and looked up, once for rows in one cell of
        the tree's thresholds."""
        cell = np.zeros(len(x), np.int64)
        bins = self.bins(x)
        for f, cuts in enumerate(self.cuts):
            if len(cuts):
                cell = np.unique(cell, return_inverse=True)[1] * (len(cuts) + 1) + bins[:, f]
        _, some, whole = np.unique(cell, return_index=True, return_inverse=True)
        together = self.joined()
        columns = [np.ravel_multi_index(bins[some][:, fs].T, [len(self.cuts[f]) + 1 for f in fs]) for fs in together]
        out = np.zeros((len(some), x.shape[1]))
        for lot in self.lots(len(some) // SHARE):
            parts, begin = self.parts(lot[0][0], lot[-1][1])
            for a, b in lot:
                edges = self.edges(a, b)
                which = begin[a - lot[0][0]: b - lot[0][0], None]       # [leaf, cell]: its row of parts
                cells, step = {}, 1
                for f, e in reversed([*enumerate(edges)]):
                    # before the first edge and after the last, no leaf has the value inside
                    cells[f] = np.searchsorted(e, np.arange(len(self.cuts[f]) + 1), "right") % len(e) * step
                    step *= len(e)
                for f, e in enumerate(edges):
                    if len(e) > 1:
                        low, high = (np.searchsorted(e, v[a:b, f], "right")[:, None] for v in (self.first, self.last))
                        inside = (np.arange(len(e)) >= low) & (np.arange(len(e)) <= high) & self.split[a:b, f, None]
                        which = (which[:, :, None] + (inside.astype(np.int64) << self.bit[a:b, f, None].clip(0))[:, None, :]).reshape(b - a, -1)
                place = 0
                for fs, column in zip(together, columns):
                    if any(len(edges[f]) > 1 for f in fs):
                        found = cells[fs[0]]
                        for f in fs[1:]:
                            found = np.add.outer(found, cells[f]).ravel()
                        place = place + found.take(column)
                table = parts.take(which[0], axis=0)
                for rows in which[1:]:
                    table += parts.take(rows, axis=0)
                out += table.take(place, axis=0)
        return out[whole]


def tree_shap(left, right, feat, thr, cover, value, X: np.ndarray) -> tuple[np.ndarray, float]:
    """Attribution of one tree for all rows of ``X``: (phi of shape rows x
    features, expected value)."""
    leaves = Leaves(left, right, feat, thr, cover, value, X.shape[1])
    return leaves.phi(X), leaves.expected


def forest_leaves(rf_model: RandomForestClassificationModel, spark, features: int) -> Iterator[list[Leaves]]:
    """The trees of a forest, in groups of about GROUP_LEAVES leaves, read back
    from the saved model; the driver holds one group at a time."""
    path = scratch_path(spark, "forest")
    rf_model.write().save(path)
    nodes = spark.read.parquet(path + "/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.impurityStats").alias("impurityStats"),
        F.col("nodeData.leftChild").alias("leftChild"), F.col("nodeData.rightChild").alias("rightChild"),
        F.col("nodeData.split.featureIndex").alias("featureIndex"),
        F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"))
    sizes = nodes.where("leftChild < 0").groupBy("treeID").agg(F.count("*").alias("n")).orderBy("treeID").collect()      # one row per tree
    group, held = [], 0
    for r in [*sizes, None]:
        if group and (r is None or held + r["n"] > GROUP_LEAVES):
            table = nodes.where(F.col("treeID").between(group[0], group[-1])).toPandas()
            yield [Leaves(*_tree_arrays(tree), features) for _, tree in table.groupby("treeID")]
            group, held = [], 0
        if r is not None:
            group.append(r["treeID"])
            held += r["n"]


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, about ROWS rows at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _explain(shared, trees: int, features: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        for batch in together(batches):
            x = np.stack([batch.column(f"_x{i}").to_numpy() for i in range(len(features))], axis=1).astype(float)
            phi = sum(tree.phi(x) for tree in group) / trees
            base = sum(tree.expected for tree in group) / trees
            whole = np.concatenate([np.full((len(x), 1), base), phi], axis=1)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * whole.shape[1]), pa.array(whole.ravel()))
            yield from pa.table([batch.column("_row"), batch.column("_id"), values], ["_row", "_id", "phi"]).to_batches()
    return run


def forest_attribution(rf_model, rows: DataFrame, features: list[str], id_col: str = "transaction_id") -> DataFrame:
    """Long form (``id_col``, feature, phi) plus one ``feature='base_value'``
    row per row of ``rows``, averaged over the trees of ``rf_model``.

    Every row is explained, in place: a forest of up to GROUP_LEAVES leaves
    needs one pass and no shuffle. A larger one takes a pass per group of trees
    over the written rows, whose partial sums are added by row number. Missing
    feature values (null or NaN) go right at each split, as in the forest."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[id_col]
    table = materialize(rows.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
                                    *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]), "explained")
    passes = [table.mapInArrow(_explain(spark.sparkContext.broadcast(group), rf_model.getNumTrees, features), f"_row long, _id {kind}, phi array<double>")
              for group in forest_leaves(rf_model, spark, len(features))]
    whole = passes[0]
    if len(passes) > 1:
        for more in passes[1:]:
            whole = whole.unionByName(more)
        whole = whole.groupBy("_row").agg(F.first("_id").alias("_id"), F.array(*[F.sum(F.col("phi")[i]) for i in range(len(features) + 1)]).alias("phi"))
    names = F.array(F.lit("base_value"), *[F.lit(c) for c in features])
    return whole.select(F.col("_id").alias(id_col), F.explode(F.arrays_zip(names.alias("feature"), "phi")).alias("_p")).select(id_col, "_p.feature", "_p.phi")
