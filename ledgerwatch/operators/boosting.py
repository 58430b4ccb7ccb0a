"""M4 for large tables: gradient-boosted trees grown over binned rows.

The trees are those of Spark's estimator (logistic loss, variance gain, all
features tried at a node, ``maxBins`` bins a feature, the first tree of weight
1); rows travel as in ``forest``. A pass over the blocks sums a level's
residuals by (node, feature, bin); what reaches the driver are a task's sums
for a level's nodes. Rows keep their score, brought up to date every KEPT
trees; a pass adds the few trees since.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame

from ..session import materialize
from . import forest as FO

KEPT = 10                    # trees after which the rows' scores are written


def takes(estimator) -> bool:
    """Whether this module grows what ``estimator`` describes."""
    if not isinstance(estimator, GBTClassifier) or any(estimator.isSet(p) for p in ("weightCol", "validationIndicatorCol")):
        return False
    return (estimator.getImpurity(), estimator.getLossType(), estimator.getFeatureSubsetStrategy(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain(),
            estimator.getMinWeightFractionPerNode(), estimator.getSubsamplingRate()) == ("variance", "logistic", "all", 1, 0.0, 0.0, 1.0) \
        and estimator.getMaxBins() <= 256 and estimator.getMaxDepth() <= 5


class Tree:
    """A tree of full depth, node j above 2j + 1 and 2j + 2. Below a leaf all
    rows go left, so the leaf's value stands at its leftmost descendant."""

    def __init__(self, depth: int, weight: float):
        self.depth, self.weight, nodes = depth, weight, (2 << depth) - 1
        self.feature, self.cut, self.gain = np.full(nodes, -1), np.full(nodes, 255, np.uint8), np.full(nodes, -1.0)
        self.sums = np.zeros((nodes, 3))           # rows, residuals, squared residuals

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Of each row, its node among those of a level."""
        at = np.zeros(bins.shape[1], np.uint8)
        for level in range(levels):
            right = np.zeros(bins.shape[1], bool)
            for j in range(1 << level):
                node = (1 << level) - 1 + j
                if self.feature[node] >= 0:
                    right |= (at == j) & (bins[self.feature[node]] > self.cut[node])
            at = at * 2 + right
        return at

    def values(self) -> np.ndarray:
        last = self.sums[(1 << self.depth) - 1:]
        return self.weight * last[:, 1] / np.maximum(last[:, 0], 1)

    def nodes(self) -> np.ndarray:
        """The nodes that rows reach, in saved order."""
        out, stack = [], [(0, -1)]
        while stack:
            j, above = stack.pop()
            if above >= 0:
                out[above][1 if out[above][1] == -2 else 2] = len(out)
            out.append([j, -1, -1])
            if self.feature[j] >= 0:
                out[-1][1] = -2          # the left child comes first
                stack += (2 * j + 2, len(out) - 1), (2 * j + 1, len(out) - 1)
        return out


def _scored(batches: Iterator[pa.RecordBatch], features: int, trees: list[Tree]):
    """Of each block: its record, bins, labels as -1 and 1, and scores."""
    added = [tree.values() for tree in trees]
    for batch in batches:
        for i in range(len(batch)):
            y = np.frombuffer(batch.column("labels")[i].as_py(), np.uint8) * 2.0 - 1
            bins = np.frombuffer(batch.column("bins")[i].as_py(), np.uint8).reshape(features, len(y))
            score = batch.column("score")[i].as_py()
            score = np.zeros(len(y)) if score is None else np.frombuffer(score).copy()
            for tree, values in zip(trees, added):
                score += values[tree.place(bins, tree.depth)]
            yield batch.slice(i, 1), bins, y, score


def _sum_level(features: int, bins_of_feature: int, trees: list[Tree], tree: Tree, level: int, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << level) * bins_of_feature
        sums = np.zeros((features, 3, size))
        for _, bins, y, score in _scored(batches, features, trees):
            r = y if first else 4 * y / (1 + np.exp(2 * y * score))
            base, squared = tree.place(bins, level).astype(np.int64) * bins_of_feature, r * r
            for f in range(features):
                at = base + bins[f]
                for k, w in enumerate((None, r, squared)):
                    sums[f, k] += np.bincount(at, w, size)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tobytes()], pa.binary())})
    return run


def _advance(features: int, trees: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record, _, _, score in _scored(batches, features, trees):
            yield pa.RecordBatch.from_arrays([record.column(c) for c in ("block", "bins", "labels")] + [pa.array([score.tobytes()], pa.binary())], ["block", "bins", "labels", "score"])
    return run


def _split_level(tree: Tree, level: int, sums: np.ndarray) -> None:
    """Splits the level's nodes by their ``sums`` [feature, 3, node, bin]."""
    left = sums.cumsum(axis=3)
    whole = left[:, :, :, -1:]
    left, right = left[..., :-1], whole - left[..., :-1]
    with np.errstate(invalid="ignore", divide="ignore"):
        kept = left[:, 1] ** 2 / left[:, 0] + right[:, 1] ** 2 / right[:, 0] - whole[:, 1] ** 2 / whole[:, 0]
        gain = np.where((left[:, 0] > 0) & (right[:, 0] > 0), kept / whole[:, 0], -1.0)         # [feature, node, bin]
    for j in range(1 << level):
        node = (1 << level) - 1 + j
        if level == 0:
            tree.sums[0] = whole[0, :, 0, 0]
        parent = (node - 1) // 2
        if level and (tree.feature[parent] < 0 or _impurity(tree.sums[node]) < 2.0 ** -52):
            tree.sums[2 * node + 1] = tree.sums[node]
            continue
        f, b = np.unravel_index(gain[:, j].argmax(), gain[:, j].shape)
        tree.sums[2 * node + 1] = tree.sums[node]
        if gain[f, j, b] > 0:
            tree.feature[node], tree.cut[node], tree.gain[node] = f, b, gain[f, j, b]
            tree.sums[2 * node + 1], tree.sums[2 * node + 2] = left[f, :, j, b], right[f, :, j, b]


def _impurity(sums: np.ndarray) -> float:
    return float(sums[2] - sums[1] ** 2 / sums[0]) / float(sums[0]) if sums[0] else 0.0


def fit(estimator, data: DataFrame, features: list[str], assembled):
    """``estimator`` fitted to ``data``: large tables by ``grow``, others and
    what it refuses by the estimator itself on ``assembled(data)``."""
    found = FO.prepared(estimator, data, features) if takes(estimator) else None
    if found is None or any(c["_y"] > 1 for c in found[1]):
        return estimator.fit(assembled(data))
    return grow(estimator, *found, len(features))


def grow(estimator: GBTClassifier, dealt: DataFrame, classes: list, features: int) -> GBTClassificationModel:
    spark, bins = dealt.sparkSession, estimator.getMaxBins()
    cuts = [FO.thresholds([(np.array(c["points"][i], float), float(c["n"])) for c in classes], bins) for i in range(features)]
    parts = FO.blocks_of(dealt, cuts, 1)        # passes are many and short
    columns = "block long, bins binary, labels binary, score binary"
    count, state = parts.rdd.getNumPartitions(), parts.selectExpr("block", "bins", "labels", "cast(null as binary) as score").persist(StorageLevel.MEMORY_AND_DISK)
    trees, since = [], []
    for i in range(estimator.getMaxIter()):
        tree = Tree(estimator.getMaxDepth(), 1.0 if i == 0 else estimator.getStepSize())
        for level in range(tree.depth):
            found = state.mapInArrow(_sum_level(features, bins, since, tree, level, i == 0), "sums binary").collect()
            _split_level(tree, level, sum(np.frombuffer(r["sums"]) for r in found).reshape(features, 3, 1 << level, bins))
        trees.append(tree), since.append(tree)
        if len(since) == KEPT and i + 1 < estimator.getMaxIter():
            after = materialize(state.mapInArrow(_advance(features, since), columns), "boosted").repartition(count).persist(StorageLevel.MEMORY_AND_DISK)
            since = []
            after.count()
            state.unpersist()
            state = after
    state.unpersist()
    parts.unpersist()

    rows = []
    for t, tree in enumerate(trees):
        for number, (j, left, right) in enumerate(tree.nodes()):
            n, total, _ = tree.sums[j].tolist()
            f = int(tree.feature[j])
            rows.append((t, number, total / n, max(_impurity(tree.sums[j]), 0.0), tree.sums[j].tolist(), int(n), float(tree.gain[j]), left, right, f, float(cuts[f][tree.cut[j]]) if f >= 0 else None))
    nodes = spark.createDataFrame(rows, "tree int, id int, prediction double, impurity double, stats array<double>, n long, gain double, left int, right int, feature int, threshold double")
    return FO.loaded(estimator, GBTClassificationModel, nodes, features, 2)
