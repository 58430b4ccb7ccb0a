"""Model comparison settings, folds, the newest feed, the importance report."""

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from support import SF_SMALL, plan_text
from ledgerwatch import params as P
from ledgerwatch.operators import analytics as A
from ledgerwatch.operators import explain as X
from ledgerwatch.operators import modelling as M
from ledgerwatch.plans import base
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import files as FS


def test_folds_hold_every_class_evenly_and_inputs_are_standardised(spark):
    t = M.comparison_table(base.features_table(spark, SF_SMALL), 5)
    sizes = {}
    for r in t.groupBy("is_fraud", "_fold").count().collect():
        sizes.setdefault(r["is_fraud"], []).append(r["count"])
    assert all(len(c) == 5 and max(c) - min(c) <= 1 for c in sizes.values())
    stats = t.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(P.MODEL_FEATURES)],
                  *[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(P.MODEL_FEATURES)], F.sum("class_weight").alias("w"), F.count("*").alias("n")).first()
    for i in range(len(P.MODEL_FEATURES)):
        assert abs(stats[f"m{i}"]) < 1e-9 and (abs(stats[f"s{i}"] - 1) < 1e-9 or stats[f"s{i}"] == 0)
    assert abs(stats["w"] - stats["n"]) < 1e-6 and stats["n"] == 1000
    assert "PartitionFilters: [isnotnull(_fold" in plan_text(t.where(F.col("_fold") != 2))


def test_logistic_regression_minimises_weighted_loss_plus_half_the_squares(spark):
    t = M.comparison_table(base.features_table(spark, SF_SMALL), 5)
    d = VectorAssembler(inputCols=P.MODEL_FEATURES, outputCol="features").transform(t)
    model = M.comparison_models(t.count())["LogisticRegression"].setTol(1e-12).fit(d)
    rows = np.array([[r[f] for f in P.MODEL_FEATURES] + [1.0, r["is_fraud"], r["class_weight"]] for r in t.collect()])
    x, y, w = rows[:, :-2], rows[:, -2], rows[:, -1]
    beta, ridge = np.zeros(x.shape[1]), np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    for _ in range(50):      # Newton's method on sum of w * loss + |beta|^2 / 2, the intercept free
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (p - y)) + ridge @ beta)
    assert np.allclose([*model.coefficients, model.intercept], beta, atol=1e-4)


def test_comparison_runs_every_fold_of_every_model(spark):
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression

    FS.logged_write(spark.range(3), scratch_path(spark, "observed"), "append", scratch_path(spark, "log"))    # its metrics are observed
    models = {"tree": DecisionTreeClassifier(labelCol="is_fraud", maxDepth=2), "line": LogisticRegression(labelCol="is_fraud", maxIter=5)}
    r = {x["model"]: x for x in M.model_comparison(base.features_table(spark, SF_SMALL), folds=3, models=models).collect()}
    assert set(r) == {"tree", "line"} and all(x["folds"] == 3 and 0 <= x["f1_score"] <= 1 and 0.5 < x["accuracy"] <= 1 for x in r.values())


def test_the_feed_computes_features_of_its_customers_only(spark):
    tx = base.tx(spark, SF_SMALL)
    feed = A.newest_scored(tx, 5)
    customers = {r[0] for r in tx.orderBy(F.col("transaction_timestamp").desc(), "transaction_id").limit(5).select("customer_id").collect()}
    assert {r[0] for r in feed.select("customer_id").distinct().collect()} == customers
    columns = ["transaction_id", "score", "prediction", "tx_count_7d", "avg_amount_30d", "is_new_merchant"]
    whole = base.scored(spark, SF_SMALL).where(F.col("customer_id").isin(customers)).select(columns)
    assert feed.select(columns).exceptAll(whole).count() == 0 and feed.count() == whole.count()


def test_the_feed_takes_rows_without_customer_and_empty_tables(spark):
    tx = base.tx(spark, SF_SMALL)
    nobody = tx.withColumn("customer_id", F.when(F.col("transaction_id") % 2 == 0, F.col("customer_id")))
    assert A.live_feed(A.newest_scored(nobody)).count() == 20
    assert A.live_feed(A.newest_scored(tx.limit(0))).count() == 0


def test_importance_report(spark):
    phi = [(1, "b", 0.5), (2, "b", -1.5), (1, "a", 1.0), (2, "a", -1.0), (1, "c", 3.0), (2, "c", None)]
    attr = spark.createDataFrame(phi, "transaction_id int, feature string, phi double")
    r = X.importance_report(attr, 2).first()
    assert r["n_features"] == 3 and r["feature_importance"] == {"a": 1.0, "b": 1.0, "c": 3.0}
    assert [(t["feature"], t["importance"]) for t in r["top_features"]] == [("c", 3.0), ("a", 1.0)]
    assert abs(r["explanation_stability"] - (1 - 0.5 / 3)) < 1e-12
    empty = X.importance_report(attr.limit(0)).first()
    assert empty["n_features"] == 0 and empty["feature_importance"] == {} and empty["top_features"] == []


def test_held_out_rows_are_explained_and_scored_by_all_cores(spark):
    test = M.stratified_split(base.features_table(spark, SF_SMALL)).where("split = 'test'")
    sizes = [r["count"] for r in M.spread(test).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == test.count() and len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 2 * min(sizes)
    assert M.forest().getCacheNodeIds()
