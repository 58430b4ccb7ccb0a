"""M7: forest TreeSHAP against brute-force Shapley values and the additivity
property Σ phi + base = predicted probability."""

import itertools
import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from support import SF_SMALL
from ledgerwatch import params as P
from ledgerwatch.operators import attribution as AT
from ledgerwatch.operators import modelling as M
from ledgerwatch.plans import base


def _brute(arrays, x):
    left, right, feat, thr, cover, value = arrays
    m = len(x)

    def cond(S):
        def rec(j):
            if left[j] < 0:
                return value[j]
            d = feat[j]
            if d in S:
                return rec(left[j] if x[d] <= thr[j] else right[j])
            return (cover[left[j]] * rec(left[j]) + cover[right[j]] * rec(right[j])) / cover[j]
        return rec(0)

    phi = np.zeros(m)
    for i in range(m):
        others = [k for k in range(m) if k != i]
        for r in range(len(others) + 1):
            for S in itertools.combinations(others, r):
                wgt = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                phi[i] += wgt * (cond(set(S) | {i}) - cond(set(S)))
    return phi


def test_tree_shap_matches_brute_force(spark):
    f = base.features(spark, SF_SMALL)
    model = M.fit_pipeline(f, M.forest(num_trees=2, max_depth=4))
    rf = model.stages[-1]
    from ledgerwatch.session import scratch_path

    path = scratch_path(spark, "rf-test")
    rf.write().save(path)
    nodes = spark.read.parquet(path + "/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.impurityStats").alias("impurityStats"),
        F.col("nodeData.leftChild").alias("leftChild"), F.col("nodeData.rightChild").alias("rightChild"),
        F.col("nodeData.split.featureIndex").alias("featureIndex"),
        F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold")).toPandas()
    X = np.array(f.select(*[F.col(c).cast("double") for c in P.MODEL_FEATURES]).limit(6).collect(), dtype=float)
    for tid, pdf in nodes.groupby("treeID"):
        arrays = AT._tree_arrays(pdf)
        phi, expected = AT.tree_shap(*arrays, X)
        for r in range(len(X)):
            assert np.allclose(phi[r], _brute(arrays, X[r]), atol=1e-9)


def test_forest_attribution_is_additive(spark):
    f = base.features(spark, SF_SMALL)
    model = M.fit_pipeline(f, M.forest(num_trees=5, max_depth=6))
    sample = M.bounded_sample(f, 40)
    attr = AT.forest_attribution(model.stages[-1], sample, P.MODEL_FEATURES)
    total = attr.groupBy("transaction_id").agg(F.sum("phi").alias("s"))
    prob = model.transform(sample).select("transaction_id", vector_to_array("probability")[1].alias("p"))
    bad = total.join(prob, "transaction_id").where(F.abs(F.col("s") - F.col("p")) > 1e-9).count()
    assert total.count() == 40 and bad == 0


def _by_boxes(leaves, x):
    """The attribution formula written out over (row, leaf, feature)."""
    above = ~(x[:, None, :] <= leaves.low) | np.isneginf(leaves.low)
    inside = above & ((x[:, None, :] <= leaves.high) | np.isposinf(leaves.high))
    points, weights = np.polynomial.legendre.leggauss(5)
    out = np.zeros(x.shape)
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = leaves.share * (1 - t) + inside * t
        for f in range(x.shape[1]):
            rest = np.delete(factor, f, axis=2).prod(axis=2)
            out[:, f] += (w * leaves.value * (inside[:, :, f] - leaves.share[:, f]) * rest).sum(axis=1)
    return out


def test_tables_equal_the_formula_on_edges_and_missing_values():
    rng = np.random.default_rng(4)
    left, right, feat, thr, cover = [-1], [-1], [-1], [0.0], [100.0]
    for j in range(60):        # node j splits, every third time with no weight on one side
        left[j], right[j], feat[j], thr[j] = len(left), len(left) + 1, int(rng.integers(0, 9)), float(rng.integers(0, 6))
        part = 0.0 if j % 3 == 2 else rng.uniform(0.2, 0.8)
        for c in (cover[j] * part, cover[j] * (1 - part)):
            left.append(-1), right.append(-1), feat.append(-1), thr.append(0.0), cover.append(c)
    leaves = AT.Leaves(left, right, feat, thr, cover, rng.uniform(0, 1, len(left)), 9)
    x = rng.integers(-1, 7, (500, 9)).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[0], x[1] = np.inf, -np.inf
    assert np.allclose(leaves.phi(x), _by_boxes(leaves, x), atol=1e-12)


def test_leaves_below_one_node_are_looked_up_together():
    """As exact as leaf by leaf, with far fewer lookups: a row's time must not
    grow with every leaf of the forest."""
    rng = np.random.default_rng(7)
    left, right, feat, thr, cover = [-1], [-1], [-1], [0.0], [1000.0]
    for j in range(150):
        left[j], right[j], feat[j], thr[j] = len(left), len(left) + 1, int(rng.integers(0, 4)) * 2, float(rng.integers(0, 12))
        part = rng.uniform(0.0, 1.0)
        for c in (cover[j] * part, cover[j] * (1 - part)):
            left.append(-1), right.append(-1), feat.append(-1), thr.append(0.0), cover.append(c)
    leaves = AT.Leaves(left, right, feat, thr, cover, rng.uniform(0, 1, len(left)), 8)
    x = rng.integers(-1, 13, (5000, 8)).astype(float)
    x[::50, 2] = np.nan
    assert np.allclose(leaves.phi(x), _by_boxes(leaves, x), atol=1e-12)
    blocks = list(leaves.blocks(1000))
    assert [a for a, _ in blocks] + [len(leaves.value)] == [0] + [b for _, b in blocks] and 3 * len(blocks) < len(leaves.value) == 151
    for place, (a, b, *_) in enumerate(leaves.spans.tolist()):
        assert leaves.cells[place] == np.prod([len(e) for e in leaves.edges(a, b)])
    assert [b - a for a, b in leaves.blocks(0)] == [1] * 151
