"""The forest grown over binned rows, as large tables are trained."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch import params as P
from ledgerwatch.operators import forest as FO
from ledgerwatch.operators import modelling as M
from ledgerwatch.session import materialize, scratch_path


def _rows(spark, n=6000):
    """Fraud above 3 of one feature or in a corner of two others; ids repeat or are missing."""
    d = spark.range(n).select(F.when(F.col("id") % 50 > 0, F.col("id") % 700).alias("transaction_id"), "id",
                              *[(F.hash("id", F.lit(i)) % 97 / 17.0).alias(f) for i, f in enumerate(P.MODEL_FEATURES)])
    a, b, c = P.MODEL_FEATURES[:3]
    return materialize(d.withColumn("is_fraud", F.when((F.col(a) > 3) | ((F.col(b) > 4) & (F.col(c) < -2)) | (F.col("id") % 211 == 0), 1).otherwise(0)), "rows")


@pytest.mark.parametrize("local_rows", [200, 10**9])
def test_grown_forest_does_the_work_of_the_estimator(spark, monkeypatch, local_rows):
    d = _rows(spark)
    plain = M.fit_pipeline(d, M.forest(num_trees=20, max_depth=6))
    monkeypatch.setattr(FO, "MIN_ROWS", 1)
    monkeypatch.setattr(FO, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(FO, "OPEN_NODES", 40)
    grown = M.fit_pipeline(d, M.forest(num_trees=20, max_depth=6))
    again = M.fit_pipeline(d, M.forest(num_trees=20, max_depth=6))
    a, b = (M.evaluate(materialize(M.score_batch(m, d), "scored")).first() for m in (plain, grown))
    assert a["n"] == b["n"] == 6000 and b["accuracy"] > a["accuracy"] - 0.03 and b["roc_auc"] > a["roc_auc"] - 0.03
    forest = grown.stages[-1]
    assert forest.getNumTrees == 20 and forest.numFeatures == 9 and max(t.depth for t in forest.trees) == 6
    assert 0.6 < forest.totalNumNodes / plain.stages[-1].totalNumNodes < 1.6
    assert again.stages[-1].toDebugString.split("\n", 1)[1] == forest.toDebugString.split("\n", 1)[1]

    path = scratch_path(spark, "nodes")
    forest.write().save(path)
    nodes = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(path + "/data").collect()}
    vote = {k: np.argmax(v["impurityStats"]) for k, v in nodes.items()}
    assert {t for t, _ in nodes} == set(range(20))
    for (t, i), v in nodes.items():
        if v["leftChild"] < 0:
            continue
        left, right = nodes[t, v["leftChild"]], nodes[t, v["rightChild"]]
        assert left["rawCount"] + right["rawCount"] == v["rawCount"] and left["rawCount"] > 0 and right["rawCount"] > 0 and v["gain"] > 0
        assert np.allclose(np.add(left["impurityStats"], right["impurityStats"]), v["impurityStats"])
        assert not (left["leftChild"] < 0 and right["leftChild"] < 0 and vote[t, v["leftChild"]] == vote[t, v["rightChild"]])


def test_small_tables_and_other_settings_stay_with_the_estimator(spark, monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier

    monkeypatch.setattr(FO, "grow", lambda *_: pytest.fail("grown"))
    d = _rows(spark, 300)
    assert M.fit_pipeline(d, M.forest(num_trees=2, max_depth=2)).stages[-1].getNumTrees == 2
    monkeypatch.setattr(FO, "MIN_ROWS", 1)
    assert M.fit_pipeline(d, DecisionTreeClassifier(labelCol="is_fraud", maxDepth=2)).stages[-1].depth <= 2
    with pytest.raises(Exception, match="NaN"):      # as before
        M.fit_pipeline(d.withColumn("hour_of_day", F.when(F.col("id") > 7, F.col("hour_of_day"))), M.forest(num_trees=2, max_depth=2))
    assert not FO.takes(M.forest().setMinInstancesPerNode(5)) and FO.takes(M.forest())


def test_thresholds_lie_where_the_weight_reaches_equal_parts():
    few = FO.thresholds([(np.array([1.0, 1.0, 3.0]), 2.0), (np.array([7.0]), 1.0)], 32)
    assert few.tolist() == [2.0, 5.0]
    even = FO.thresholds([(np.arange(0.0, 1001.0), 10.0)], 4)
    assert np.allclose(even, [250, 500, 750], atol=1.5)
    half = FO.thresholds([(np.arange(0.0, 1001.0), 1.0), (np.arange(1001.0, 2002.0), 3.0)], 4)
    assert np.allclose(half, [1000, 1333, 1667], atol=2)


def test_bootstrap_draws_follow_poisson():
    w = FO.weights_of(42, 3, 7, 1_000_000)
    assert abs(w.mean() - 1) < 0.005 and abs(w.var() - 1) < 0.01 and abs((w == 0).mean() - np.exp(-1)) < 0.002 and w.max() < 16
    assert (w[:1000] != FO.weights_of(42, 4, 7, 1000)).any()


def test_boosted_trees_are_those_of_the_estimator(spark, monkeypatch):
    """Few values a feature, so that both have the same thresholds."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from ledgerwatch.operators import boosting as BO

    d = _rows(spark, 4000).select("id", "is_fraud", *[F.floor(F.col(f) * 2).cast("double").alias(f) for f in P.MODEL_FEATURES])
    asm = VectorAssembler(inputCols=P.MODEL_FEATURES, outputCol="features")
    gbt = GBTClassifier(labelCol="is_fraud", maxIter=8, maxDepth=3, stepSize=0.1, seed=1)
    plain = M.fit_estimator(gbt.copy(), d, P.MODEL_FEATURES, asm)
    monkeypatch.setattr(FO, "MIN_ROWS", 1)
    monkeypatch.setattr(BO, "KEPT", 3)
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, rows, fit=GBTClassifier.fit: fit(self, rows) if rows.count() == 2 else pytest.fail("not grown"))
    grown = M.fit_estimator(gbt.copy(), d, P.MODEL_FEATURES, asm)
    assert grown.treeWeights == plain.treeWeights == [1.0] + [0.1] * 7
    raw = [{r["id"]: r["rawPrediction"][1] for r in m.transform(asm.transform(d)).collect()} for m in (plain, grown)]
    assert max(abs(raw[0][i] - raw[1][i]) for i in raw[0]) < 1e-9 and len(raw[1]) == 4000
    assert grown.totalNumNodes == plain.totalNumNodes
    assert np.allclose(grown.featureImportances.toArray(), plain.featureImportances.toArray(), atol=1e-6)
    assert not BO.takes(gbt.copy().setSubsamplingRate(0.5)) and BO.takes(M.comparison_models(10)["GradientBoosting"])
