"""M3 for large tables: a random forest grown over binned rows.

The trees are those of Spark's estimator (Poisson(1) bootstrap, Gini gain of
class-weighted counts, ``maxBins`` bins a feature at weighted quantiles, the
square root of the features tried at a node, sibling leaves of one vote
merged). What differs is how rows travel:

- rows are binned once, one byte a feature, in blocks of up to ROWS rows; a
  row's weight in a tree is drawn from (seed, tree, block), never stored;
- while a node has many rows, its counts by (feature, bin, class) are summed
  over all blocks, a pass a level; a tree's counts meet in one task;
- the rows of a node with few of them (LOCAL_ROWS) are brought together, and
  the tree below it is grown in one task. Rows of pure nodes travel no further.

The driver holds the nodes above those trees, and the finished forest, as it
does for Spark's estimator.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .attribution import together

MIN_ROWS = 1 << 18           # smaller tables are left to Spark's estimator
LOCAL_ROWS = 300_000         # weighted rows of a node whose tree is grown in one task; of large
LOCAL_SHARE = 16             # tables this part of them, so that the passes stay as many,
LOCAL_MOST = 2_000_000       # up to these
OPEN_NODES = 1 << 15         # nodes whose counts are summed in one pass
HELD = 1 << 26               # bytes of rows a task holds before it sends them on
PART_ROWS = 500_000          # rows of a partition at most
POINTS = 500                 # quantiles of a class that thresholds are chosen from
CHUNK = 2048                 # nodes whose splits are compared at a time
OPEN, INNER, LEAF, LOCAL = range(4)

# Poisson(1) by 16 random bits
_CUMULATED = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(10)])
DRAWS = np.searchsorted(_CUMULATED, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def node_type(classes: int) -> np.dtype:
    return np.dtype([("id", "<i4"), ("left", "<i4"), ("right", "<i4"), ("feature", "<i4"), ("cut", "<i4"), ("gain", "<f8"), ("counts", "<f8", (classes,))])


def takes(estimator) -> bool:
    """Whether this module grows what ``estimator`` describes."""
    if not isinstance(estimator, RandomForestClassifier) or not estimator.isSet("weightCol"):
        return False
    return (estimator.getImpurity(), estimator.getFeatureSubsetStrategy(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain(),
            estimator.getMinWeightFractionPerNode(), estimator.getSubsamplingRate(), estimator.getBootstrap()) == ("gini", "auto", 1, 0.0, 0.0, 1.0, True) \
        and estimator.getMaxBins() <= 256


def prepared(estimator, data: DataFrame, features: list[str]) -> tuple[DataFrame, list] | None:
    """Of a large table: class ``_y`` and values ``_x0``, ``_x1``..., dealt
    evenly and written once, and by class the rows, the weight of one and the
    quantiles of each feature. None for small tables and where weights differ
    within a class or values aren't finite."""
    if (rows := data.count()) < MIN_ROWS:
        return None
    weight = F.col(estimator.getWeightCol()) if estimator.isSet("weightCol") else F.lit(1.0)
    values = [F.when(F.abs(F.col(f).cast("double")) < float("inf"), F.col(f).cast("double")).alias(f"_x{i}") for i, f in enumerate(features)]
    dealt = data.select(F.col(estimator.getLabelCol()).cast("int").alias("_y"), weight.alias("_w"), *values)
    dealt = materialize(dealt.repartition(max(data.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))), "dealt")
    points = [F.percentile_approx(f"_x{i}", F.array(*[F.lit(p / POINTS) for p in range(POINTS + 1)]), F.lit(10 * POINTS)) for i in range(len(features))]
    classes = dealt.groupBy("_y").agg(F.count(F.lit(1)).alias("n"), F.min("_w").alias("low"), F.max("_w").alias("high"), F.array(*points).alias("points"),
                                      F.array(*[F.count(f"_x{i}") for i in range(len(features))]).alias("known")).collect()
    if 1 < len(classes) and all(c["_y"] in range(16) and c["low"] == c["high"] > 0 and set(c["known"]) == {c["n"]} for c in classes):
        return dealt, sorted(classes, key=lambda c: c["_y"])
    return None


def fit(estimator, data: DataFrame, features: list[str], assembled):
    """``estimator`` fitted to ``data``: large tables by ``grow``, others and
    what it refuses by the estimator itself on ``assembled(data)``."""
    found = prepared(estimator, data, features) if takes(estimator) else None
    return estimator.fit(assembled(data)) if found is None else grow(estimator, *found, len(features))


def thresholds(points: list[tuple[np.ndarray, float]], bins: int) -> np.ndarray:
    """At most ``bins - 1`` thresholds: between all neighbouring values if
    these are few, else, as Spark's estimator places them, where the weight
    comes closest to each next of ``bins`` equal parts. ``points`` has each
    class's quantiles and its weight."""
    values, at = np.unique(np.concatenate([p for p, _ in points]), return_inverse=True)
    mass = np.bincount(at, np.concatenate([np.full(len(p), w / len(p)) for p, w in points]))
    between = (values[:-1] + values[1:]) / 2
    if len(between) < bins:
        return between
    part, cuts, reached = mass.sum() / bins, [], np.cumsum(mass)
    for i, cut in enumerate(between):
        target = part * (len(cuts) + 1)
        if len(cuts) < bins - 1 and abs(reached[i] - target) < abs(reached[i + 1] - target):
            cuts.append(cut)
    return np.array(cuts)


def weights_of(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often the tree's bootstrap draws each row of the block."""
    return DRAWS[np.random.Generator(np.random.SFC64([seed, tree, block])).integers(0, 1 << 16, rows, np.uint16)]


def subsets(seed: int, tree: int, place: int, nodes: int, features: int, tried: int) -> np.ndarray:
    """[node, tried]: the features that may split each node."""
    return np.random.Generator(np.random.SFC64([seed, tree, place, 1])).random((nodes, features)).argsort(axis=1)[:, :tried]


def best_splits(sums: np.ndarray, class_weight: np.ndarray):
    """Of ``sums`` [node, tried, bin, class], per node: its gain (0 and less:
    none), which tried feature, the last bin on the left and the left counts."""
    gain, place, left_counts = (np.zeros(len(sums)), np.zeros(len(sums), np.int64), np.zeros((len(sums), sums.shape[3])))

    def impurity(counts):
        weight = (counts * class_weight).sum(axis=-1)
        with np.errstate(invalid="ignore", divide="ignore"):
            return weight, 1 - (((counts * class_weight) / weight[..., None]) ** 2).sum(axis=-1)

    for at in range(0, len(sums), CHUNK):
        part = sums[at: at + CHUNK]
        left = part.cumsum(axis=2)
        total = left[:, :1, -1:]
        left = left[:, :, :-1]
        (lw, li), (rw, ri), (tw, ti) = impurity(left), impurity(total - left), impurity(total)
        with np.errstate(invalid="ignore"):
            g = ti - (lw / tw) * li - (rw / tw) * ri
        g = np.where((lw > 0) & (rw > 0), g, -1.0).reshape(len(part), -1)
        best = g.argmax(axis=1)
        gain[at: at + CHUNK], place[at: at + CHUNK] = g[np.arange(len(part)), best], best
        left_counts[at: at + CHUNK] = left.reshape(len(part), -1, sums.shape[3])[np.arange(len(part)), best]
    return gain, place // (sums.shape[2] - 1), place % (sums.shape[2] - 1), left_counts


def counted(slot, tried, flat, n, rows, weight, label, nodes: int, bins: int, classes: int) -> np.ndarray:
    """Weights by (node, tried feature, bin, class) of rows at ``slot``."""
    width = tried.shape[1]
    base = slot * (width * bins * classes) + label
    out = 0
    for s in range(width):
        b = flat[tried[slot, s] * n + rows].astype(np.int64)
        out = out + np.bincount(base + (b + s * bins) * classes, weight, nodes * width * bins * classes)
    return out


class Tree:
    """The nodes of one tree as far as it has grown from the root; the right
    child follows the left one."""

    def __init__(self, classes: int, local_rows: int):
        self.local_rows = local_rows
        self.kind, self.depth = [OPEN], [0]
        self.feature, self.cut, self.left, self.gain = [-1], [0], [-1], [-1.0]
        self.counts = [np.zeros(classes)]

    def split(self, node: int, feature: int, cut: int, gain: float, left, right, max_depth: int) -> None:
        self.kind[node], self.feature[node], self.cut[node], self.gain[node], self.left[node] = INNER, feature, cut, gain, len(self.kind)
        for counts in (left, right):
            depth = self.depth[node] + 1
            done = depth >= max_depth or np.count_nonzero(counts) < 2
            self.kind.append(LEAF if done else LOCAL if counts.sum() <= self.local_rows else OPEN)
            self.depth.append(depth), self.counts.append(counts)
            self.feature.append(-1), self.cut.append(0), self.left.append(-1), self.gain.append(-1.0)

    def opened(self) -> np.ndarray:
        return np.flatnonzero(np.array(self.kind) == OPEN)

    def frozen(self, tried=None) -> dict[str, np.ndarray]:
        slot = np.cumsum(np.array(self.kind) == OPEN) - 1
        return {"kind": np.array(self.kind, np.int8), "feature": np.array(self.feature, np.int64), "cut": np.array(self.cut, np.uint8),
                "left": np.array(self.left, np.int32), "slot": slot, "tried": tried}


def reached(tree: dict, flat: np.ndarray, n: int, rows: np.ndarray, kind: int):
    """(rows, their nodes): of ``rows``, those that end at a node of the kind."""
    at, some, nodes = tree["feature"] * n, [], []
    node = np.zeros(len(rows), np.int32)
    while len(rows):
        kinds = tree["kind"][node]
        inner = np.flatnonzero(kinds == INNER)
        if len(inner) < len(rows):
            hit = np.flatnonzero(kinds == kind)
            some.append(rows[hit]), nodes.append(node[hit])
            rows, node = rows[inner], node[inner]
        node = tree["left"][node] + (flat[at[node] + rows] > tree["cut"][node])
    return (np.concatenate(some), np.concatenate(nodes)) if some else (rows, node)


def _bin(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, batch in enumerate(together(batches)):
            x = [batch.column(f"_x{i}").to_numpy().astype(float) for i in range(len(cuts))]
            bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x)]).astype(np.uint8)
            y = batch.column("_y").to_numpy().astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"block": pa.array([part << 32 | at]), "bins": pa.array([bins.tobytes()], pa.binary()), "labels": pa.array([y.tobytes()], pa.binary())})
    return run


def blocks_of(dealt: DataFrame, cuts: list[np.ndarray], tasks: int = 3) -> DataFrame:
    """The rows binned, in blocks that are kept at hand, dealt evenly to
    ``tasks`` tasks a core."""
    binned = materialize(dealt.mapInArrow(_bin(cuts), "block long, bins binary, labels binary"), "binned")
    cores = dealt.sparkSession.sparkContext.defaultParallelism
    return binned.repartition(max(cores, min(tasks * cores, binned.count()))).persist(StorageLevel.MEMORY_AND_DISK)


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for block, bins, labels in zip(batch.column("block"), batch.column("bins"), batch.column("labels")):
            y = np.frombuffer(labels.as_py(), np.uint8)
            yield block.as_py(), np.frombuffer(bins.as_py(), np.uint8), y, len(y)


def _sum_level(shared, seed: int, bins: int, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, sums = shared.value, {}
        for block, flat, y, n in _blocks(batches):
            for t, tree in trees.items():
                w = weights_of(seed, t, block, n)
                rows, node = reached(tree, flat, n, np.flatnonzero(w), OPEN)
                if len(rows):
                    found = counted(tree["slot"][node], tree["tried"], flat, n, rows, w[rows], y[rows], len(tree["tried"]), bins, classes)
                    sums[t] = sums[t] + found if t in sums else found
        for t in sums:
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "sums": pa.array([sums[t].astype("<i4").tobytes()], pa.binary())})
    return run


def _choose(shared, bins: int, class_weight: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        t = table.column("tree")[0].as_py()
        total = 0
        for s in table.column("sums"):
            total = total + np.frombuffer(s.as_py(), "<i4").astype(np.float64)
        tried = shared.value[t]["tried"]
        total = total.reshape(len(tried), tried.shape[1], bins, len(class_weight))
        gain, which, cut, left = best_splits(total, class_weight)
        counts = total[:, 0].sum(axis=1)
        return pa.table({"tree": pa.array([t] * len(gain), pa.int32()), "slot": pa.array(np.arange(len(gain)), pa.int32()), "gain": gain,
                         "feature": pa.array(tried[np.arange(len(gain)), which], pa.int32()), "cut": pa.array(cut, pa.int32()),
                         "left": pa.array(list(left), pa.list_(pa.float64())), "counts": pa.array(list(counts), pa.list_(pa.float64()))})
    return run


def _gather(shared, seed: int, features: int):
    def sent(held):
        yield pa.RecordBatch.from_pydict({"tree": pa.array([t for t, _ in held], pa.int32()), "node": pa.array([v for _, v in held], pa.int32()),
                                          "rows": pa.array([b"".join(parts) for parts in held.values()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for block, flat, y, n in _blocks(batches):
            whole = np.concatenate([flat.reshape(features, n), np.zeros((1, n), np.uint8)]).T.copy()
            for t, tree in shared.value.items():
                w = weights_of(seed, t, block, n)
                rows, node = reached(tree, flat, n, np.flatnonzero(w), LOCAL)
                order = node.argsort(kind="stable")
                rows, node = rows[order], node[order]
                records = whole[rows]
                records[:, features] = y[rows] << 4 | w[rows]
                for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(node)) + 1) if len(rows) else []:
                    held.setdefault((t, int(node[part[0]])), []).append(records[part[0]: part[-1] + 1].tobytes())
                size += records.size
                if size >= HELD:
                    yield from sent(held)
                    held, size = {}, 0
        if held:
            yield from sent(held)
    return run


def subtree(records: np.ndarray, depth: int, class_weight: np.ndarray, bins: int, tried: int, seed: int, tree: int, place: int) -> np.ndarray:
    """The tree of the rows ``records`` (bins, then class and weight in a
    byte), at most ``depth`` deep, sibling leaves of one vote merged."""
    n, features, classes = len(records), records.shape[1] - 1, len(class_weight)
    flat = np.ascontiguousarray(records[:, :features].T).ravel()
    y, w = records[:, features] >> 4, records[:, features] & 15
    nodes = [np.zeros(1, node_type(classes))]
    nodes[0]["left"], nodes[0]["feature"], nodes[0]["gain"] = -1, -1, -1.0
    nodes[0]["counts"] = np.bincount(y, w, classes)
    rows, slot, count = np.arange(n), np.zeros(n, np.int64), 1
    opened = np.zeros(1, np.int64)            # places in the last level of nodes
    for level in range(depth):
        if not len(opened):
            break
        options = subsets(seed, tree, place << 5 | level, len(opened), features, tried)
        sums = counted(slot, options, flat, n, rows, w[rows], y[rows], len(opened), bins, classes).reshape(len(opened), tried, bins, classes)
        gain, which, cut, left = best_splits(sums, class_weight)
        good = np.flatnonzero(gain > 0)
        feature = options[np.arange(len(opened)), which]
        last = nodes[-1]
        for name, values in (("feature", feature), ("cut", cut), ("gain", gain), ("left", count + 2 * (np.cumsum(gain > 0) - 1))):
            last[name][opened[good]] = values[good]
        children = np.zeros(2 * len(good), node_type(classes))
        children["left"], children["feature"], children["gain"] = -1, -1, -1.0
        children["counts"][0::2] = left[good]
        children["counts"][1::2] = last["counts"][opened[good]] - left[good]
        nodes.append(children)
        count += len(children)
        child = np.full(len(opened), -1)
        child[good] = 2 * np.arange(len(good))
        on = np.flatnonzero(child[slot] >= 0)
        rows, slot = rows[on], slot[on]
        at = child[slot] + (flat[feature[slot] * n + rows] > cut[slot])
        opened = np.flatnonzero((children["counts"] > 0).sum(axis=1) > 1)
        place_of = np.full(len(children), -1)
        place_of[opened] = np.arange(len(opened))
        on = np.flatnonzero(place_of[at] >= 0) if len(at) else np.zeros(0, np.int64)
        rows, slot = rows[on], place_of[at[on]]
    return pruned(np.concatenate(nodes), class_weight)


def pruned(nodes: np.ndarray, class_weight: np.ndarray, leaf_vote: dict[int, int] | None = None) -> np.ndarray:
    """``nodes`` (children later than their parent, right after left) without
    sibling leaves of one vote, numbered anew. ``leaf_vote`` has what stands at
    nodes that are no leaf here: a vote, or -1 for a tree."""
    vote = (nodes["counts"] * class_weight).argmax(axis=1)
    left = nodes["left"].copy()
    leaf = left < 0
    for j, v in (leaf_vote or {}).items():
        leaf[j], vote[j] = v >= 0, v
    for j in np.flatnonzero(left >= 0)[::-1].tolist():
        a = left[j]
        if leaf[a] and leaf[a + 1] and vote[a] == vote[a + 1]:
            left[j], leaf[j] = -1, True
    alive = np.zeros(len(nodes), bool)
    alive[0] = True
    for j in np.flatnonzero(left >= 0).tolist():
        if alive[j]:
            alive[left[j]] = alive[left[j] + 1] = True
    number = np.cumsum(alive) - 1
    out = nodes[alive].copy()
    inner = left[alive] >= 0
    out["id"] = np.flatnonzero(alive) if leaf_vote is not None else number[alive]
    out["left"] = np.where(inner, number[left[alive]], -1)
    out["right"] = np.where(inner, out["left"] + 1, -1)
    out["feature"][~inner], out["gain"][~inner] = -1, -1.0
    return out


def _finish(depths, class_weight, bins: int, tried: int, features: int, seed: int, max_depth: int):
    def run(table: pa.Table) -> pa.Table:
        t, v = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        records = np.concatenate([np.frombuffer(r.as_py(), np.uint8) for r in table.column("rows")]).reshape(-1, features + 1)
        records = records[np.lexsort(records.T)]            # so that the order of arrival doesn't matter
        nodes = subtree(records, max_depth - depths.value[t][v], class_weight, bins, tried, seed, t, v)
        vote = int((nodes["counts"][0] * class_weight).argmax()) if len(nodes) == 1 else -1
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([v], pa.int32()), "size": pa.array([len(nodes)], pa.int32()),
                         "vote": pa.array([vote], pa.int32()), "nodes": pa.array([nodes.tobytes()], pa.binary())})
    return run


def _rows_of_nodes(class_weight: np.ndarray, cuts: list[np.ndarray]):
    """Nodes as rows of a saved forest: the first one is numbered ``top``, the
    others follow from ``base``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, payload, top, base in zip(*(batch.column(c).to_pylist() for c in ("tree", "nodes", "top", "base"))):
                d = np.frombuffer(payload, node_type(len(class_weight)))
                moved = lambda v: np.where(v < 0, -1, np.where(v == 0, top, base + v - 1))      # noqa: E731
                stats = d["counts"] * class_weight
                threshold = [float(cuts[f][c]) if f >= 0 else None for f, c in zip(d["feature"].tolist(), d["cut"].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(len(d), t), pa.int32()), "id": pa.array(moved(d["id"]), pa.int32()), "prediction": stats.argmax(axis=1).astype(float),
                    "impurity": 1 - ((stats / stats.sum(axis=1, keepdims=True)) ** 2).sum(axis=1), "stats": pa.array(list(stats), pa.list_(pa.float64())),
                    "n": pa.array(d["counts"].sum(axis=1).astype(np.int64)), "gain": d["gain"], "left": pa.array(moved(d["left"]), pa.int32()),
                    "right": pa.array(moved(d["right"]), pa.int32()), "feature": pa.array(d["feature"], pa.int32()), "threshold": pa.array(threshold, pa.float64())})
    return run


def grow(estimator: RandomForestClassifier, dealt: DataFrame, classes: list, features: int) -> RandomForestClassificationModel:
    """The forest that ``estimator`` describes, from what ``prepared`` gives."""
    spark, bins, max_depth, seed = dealt.sparkSession, estimator.getMaxBins(), estimator.getMaxDepth(), estimator.getSeed() % (1 << 63)
    n_classes = max(c["_y"] for c in classes) + 1
    class_weight = np.zeros(n_classes)
    for c in classes:
        class_weight[c["_y"]] = c["low"]
    cuts = [thresholds([(np.array(c["points"][i], float), c["low"] * c["n"]) for c in classes], bins) for i in range(features)]
    tried = features if estimator.getNumTrees() == 1 else int(np.ceil(np.sqrt(features)))

    cores, blocks = spark.sparkContext.defaultParallelism, blocks_of(dealt, cuts)

    local_rows = max(LOCAL_ROWS, min(sum(c["n"] for c in classes) // LOCAL_SHARE, LOCAL_MOST))
    trees = [Tree(n_classes, local_rows) for _ in range(estimator.getNumTrees())]
    level = 0
    while growing := [t for t, tree in enumerate(trees) if len(tree.opened())]:
        while growing:
            some, held = {}, 0
            while growing and (not some or held + len(trees[growing[0]].opened()) <= OPEN_NODES):
                t = growing.pop(0)
                n = len(trees[t].opened())
                some[t], held = trees[t].frozen(subsets(seed, t, level, n, features, tried)), held + n
            shared = spark.sparkContext.broadcast(some)
            sums = blocks.mapInArrow(_sum_level(shared, seed, bins, n_classes), "tree int, sums binary")
            found = sums.groupBy("tree").applyInArrow(_choose(shared, bins, class_weight), "tree int, slot int, gain double, feature int, cut int, left array<double>, counts array<double>").collect()
            opened = {t: trees[t].opened() for t in some}
            for r in found:
                tree, node, counts = trees[r["tree"]], int(opened[r["tree"]][r["slot"]]), np.array(r["counts"])
                tree.counts[node], tree.kind[node] = counts, LEAF
                if r["gain"] > 0 and tree.depth[node] < max_depth:
                    tree.split(node, r["feature"], r["cut"], r["gain"], np.array(r["left"]), counts - np.array(r["left"]), max_depth)
            shared.destroy()
        level += 1

    local = sum(c.sum() for tree in trees for c, k in zip(tree.counts, tree.kind) if k == LOCAL)
    shared = spark.sparkContext.broadcast({t: tree.frozen() for t, tree in enumerate(trees)})
    depths = spark.sparkContext.broadcast([tree.depth for tree in trees])
    parts = max(4 * cores, int(local * (features + 1)) >> 27)
    gathered = blocks.mapInArrow(_gather(shared, seed, features), "tree int, node int, rows binary").repartition(parts, "tree", "node")
    below = materialize(gathered.groupBy("tree", "node").applyInArrow(_finish(depths, class_weight, bins, tried, features, seed, max_depth),
                                                                        "tree int, node int, size int, vote int, nodes binary"), "subtrees")
    blocks.unpersist()

    found = {t: {} for t in range(len(trees))}
    for r in below.select("tree", "node", "size", "vote").collect():
        found[r["tree"]][r["node"]] = (r["size"], r["vote"])
    tops, places = [], []
    for t, tree in enumerate(trees):
        d = np.zeros(len(tree.kind), node_type(n_classes))
        for name in ("left", "feature", "cut", "gain", "counts"):
            d[name] = getattr(tree, name)
        d = pruned(d, class_weight, {v: vote for v, (_, vote) in found[t].items()})
        base, own = len(d), []
        for number, node in enumerate(d["id"].tolist()):
            if node in found[t] and d["left"][number] < 0 and tree.kind[node] == LOCAL:
                places.append((t, node, number, base))
                base += found[t][node][0] - 1
            else:
                own.append(number)
        d["id"] = np.arange(len(d))
        tops.append((t, bytearray(d[own].tobytes()), 0, 1))
    moved = below.join(F.broadcast(spark.createDataFrame(places, "tree int, node int, top int, base int")), ["tree", "node"]).select("tree", "nodes", "top", "base")
    whole = spark.createDataFrame(tops, "tree int, nodes binary, top int, base int").unionByName(moved)
    saved = whole.mapInArrow(_rows_of_nodes(class_weight, cuts), "tree int, id int, prediction double, impurity double, stats array<double>, n long, gain double, "
                             "left int, right int, feature int, threshold double")
    return loaded(estimator, RandomForestClassificationModel, saved, features, n_classes)


def loaded(estimator, kind, nodes: DataFrame, features: int, classes: int):
    """A model of the class ``kind`` with these nodes, by way of a saved one: a
    model fitted to one row a class, whose nodes are replaced."""
    spark, path = nodes.sparkSession, scratch_path(nodes.sparkSession, "grown")
    rows = spark.createDataFrame([(Vectors.dense([float(c)] * features), c, 1.0) for c in range(classes)],
                                 [estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getWeightCol() if estimator.isSet("weightCol") else "_w"]).coalesce(1)
    estimator.fit(rows).write().save(path)
    split = F.struct("feature", F.when(F.col("feature") < 0, F.array().cast("array<double>")).otherwise(F.array("threshold")), F.lit(-1))
    data = F.struct("id", "prediction", "impurity", "stats", "n", "gain", "left", "right", split)
    saved = ("struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
            "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")
    nodes.select(F.col("tree").alias("treeID"), data.cast(saved).alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    return kind.load(path)
