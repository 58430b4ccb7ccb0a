"""Versioned state, saved models, distributed prefix sums and selection,
mergeable drift counts, attribution of every row."""

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from support import SF_SMALL, plan_text
from ledgerwatch import params as P
from ledgerwatch.operators import analytics as A
from ledgerwatch.operators import attribution as AT
from ledgerwatch.operators import drift as D
from ledgerwatch.operators import evaluation as E
from ledgerwatch.operators import features as FE
from ledgerwatch.operators import green as G
from ledgerwatch.operators import modelling as M
from ledgerwatch.operators import quality as Q
from ledgerwatch.operators import windows as W
from ledgerwatch.plans import base, q_modelling
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import files as FS
from ledgerwatch.sources import versions as V


def _odd_amounts(spark):
    """A burst of one instant, a third of the keys null, NaN, infinities, tiny
    and huge amounts, repeated ids, null times."""
    rng = random.Random(7)
    amounts = [1e-9, 2e-9, float("nan"), float("inf"), float("-inf"), None, 12.25, 0.1, 3e12, -5.5]
    rows = []
    for i in range(900):
        key = None if i % 3 == 0 else i % 2
        second = 5_000 if 200 <= i < 600 else None if i % 97 == 0 else rng.randrange(60) * 86_400
        amount = rng.choice(amounts) if i % 5 == 0 else rng.choice([1e-9, 2e-9]) if key == 1 else rng.choice([12.25, 0.1, None])
        rows.append((i % 400 if i % 11 else None, key, rng.choice([None, 1, 2]), second, amount))
    return spark.createDataFrame(rows, "transaction_id long, customer_id long, merchant_id long, s long, transaction_amount double").withColumn(
        "transaction_timestamp", F.timestamp_seconds(F.col("s") + 1_600_000_000).cast("timestamp_ntz")).drop("s")


def _sorted_rows(df, mean):
    number = lambda v: (0, 0.0) if v is None else (1, 0.0) if v != v else (2, float(f"{v:.9e}"))
    return sorted([tuple(str(r[c]) for c in df.columns if c != mean) + number(r[mean]) for r in df.collect()])


def test_ranged_windows_equal_plain_on_odd_values(spark):
    df = _odd_amounts(spark)
    cols = ["transaction_id", "customer_id", "transaction_timestamp", "merchant_id", "tx_count_7d", "merchant_count_30d", "avg_amount_30d"]
    plain = _sorted_rows(FE.trailing_features(df, "window").select(*cols), "avg_amount_30d")
    for other in (FE.trailing_features(df, "ranged"), FE.trailing_features(df, hot_rows=100)):
        got = _sorted_rows(other.select(*cols), "avg_amount_30d")
        assert len(got) == 900 and [g[:-2] for g in got] == [p[:-2] for p in plain]
        for g, p in zip(got, plain):
            assert g[-2] == p[-2] and (g[-1] == p[-1] or abs(g[-1] - p[-1]) <= 1e-9 * abs(p[-1]) + 1e-12 * (abs(p[-1]) > 1))


def test_running_windows_equal_plain(spark):
    df = _odd_amounts(spark).where("transaction_id is not null").dropDuplicates(["customer_id", "transaction_timestamp", "transaction_id"])
    for make, name in ((FE.prior_mean_amount, "avg_amount_prior"), (FE.first_activity, "is_first_activity")):
        cols = ["transaction_id", "customer_id", "transaction_timestamp", name]
        plain, split = _sorted_rows(make(df, "window").select(*cols), name), _sorted_rows(make(df, hot_rows=50).select(*cols), name)
        assert [p[:-1] for p in plain] == [s[:-1] for s in split]
        assert all(p[-1] == s[-1] or abs(p[-1] - s[-1]) <= 1e-6 * abs(p[-1]) for p, s in zip(plain, split))


def test_first_at_merchant_marks_one_row_of_repeated_ids(spark):
    rows = [(1, 7, 3, "2024-01-01 00:00:00"), (1, 7, 3, "2024-01-02 00:00:00"), (1, 7, 4, "2024-01-02 00:00:00"), (2, 7, 3, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, merchant_id long, t string").select("*", F.col("t").cast("timestamp_ntz").alias("transaction_timestamp"))
    got = sorted((r.merchant_id, r.t, r.transaction_id, r.is_first_at_merchant) for r in FE.first_at_merchant(df).collect())
    assert [g[-1] for g in got] == [1, 0, 0, 1]


def test_no_range_holds_a_burst(spark):
    rows = spark.range(8000).selectExpr("0 as k", "timestamp_seconds(1600000000) as ts", "id", "1 as n")
    W.prefix_sums(rows, ["k"], [F.col("ts"), F.col("id")], ["n"]).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # which would join ranges this small
    try:
        ranged = W.ranged(rows, [F.col("k"), F.col("ts"), F.col("id")], "burst")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ranged.groupBy("_part").count().agg(F.max("count")).first()[0] <= 2 * 8000 / 8
    summed = W.prefix_sums(rows, ["k"], [F.col("ts"), F.col("id")], ["n"])
    assert summed.where("_before_n <> id").isEmpty()


def test_auc_of_tiny_scores(spark):
    rng = np.random.default_rng(4)
    score, y = np.round(rng.random(4000), 3) * 1e-7, rng.integers(0, 2, 4000)
    df = spark.createDataFrame([(float(s), int(t)) for s, t in zip(score, y)] + [(None, 1), (0.5, None)], "score double, is_fraud int")
    pos, neg = score[y == 1], score[y == 0]
    less = np.searchsorted(np.sort(neg), pos, "left").sum() + 0.5 * (np.searchsorted(np.sort(neg), pos, "right") - np.searchsorted(np.sort(neg), pos, "left")).sum()
    assert abs(E.roc_auc(df).first()["roc_auc"] - less / (len(pos) * len(neg))) < 1e-12


def test_quantile_of_many_doubles(spark, monkeypatch):
    df = spark.range(1_000_000).select(F.exp(F.rand(3) * 60 - 30).alias("v")).unionByName(spark.createDataFrame([(None,)], "v double"))
    df = df.sparkSession.createDataFrame(df.toPandas())          # fixed values
    x = np.array([r[0] for r in df.where("v is not null").where(~F.isnan("v")).collect()])
    df = df.where(~F.isnan("v"))
    for q in (0.0, 0.013, 0.5, 0.95, 1.0):
        assert abs(A.exact_quantile(df, "v", q).first()["value"] / np.quantile(x, q) - 1) < 1e-12
    monkeypatch.setattr(A, "QUANTILE_LEFT", 1)
    odd = [-1.5e308, 1.5e308, 0.0, -0.0, 5e-324, 1.0, 1.0, 1.0, float("inf"), float("-inf"), float("nan")]
    small = spark.createDataFrame([(v,) for v in odd], "v double")
    order = sorted(odd[:-1]) + [float("nan")]
    for k, want in enumerate(order):
        got = A.exact_quantile(small, "v", k / (len(odd) - 1)).first()["value"]
        assert got == want or (got != got and want != want)
    assert A.exact_quantile(small.limit(0), "v", 0.5).first()["value"] is None


def test_counts_add_up_over_batches(spark):
    s = base.scored_table(spark, SF_SMALL)
    b, c = s.where("cohort = 'baseline'"), s.where("cohort = 'current'")
    counts = D.baseline_counts(b)
    days = D.bin_counts(c.withColumn("day", F.to_date("transaction_timestamp")), counts.select("lo", "hi"), by=["day"])
    whole = D.with_drift(D.merged(days.drop("day")), counts).first()
    assert abs(whole["psi"] - D.psi(b, c).first()["psi"]) < 1e-9 and abs(whole["kl_divergence"] - D.kl_divergence(b, c).first()["kl_divergence"]) < 1e-9
    report = D.drift_report(s)
    assert report.first()["current_mean"] is not None and plan_text(report).count("Exchange hashpartitioning") <= 4
    alone = D.drift_report(b).first()
    assert alone["psi"] is None and alone["severity"] == "LOW" and not alone["should_retrain"]


def test_two_first_runs_share_one_baseline(spark):
    root = scratch_path(spark, "race")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: V.read_or_create(spark, root, lambda: spark.range(i, i + 1))[0].first()[0], range(4)))
    assert len(set(got)) == 1 and V.versions(spark, root) == [0]
    assert V.save_table(spark.range(9), root) == 1 and V.read_table(spark, root).count() == 9 and V.read_table(spark, root, 0).count() == 1
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, scratch_path(spark, "nothing"))


def test_concurrent_writers_get_versions_of_their_own(spark):
    log = scratch_path(spark, "log")
    with ThreadPoolExecutor(4) as pool:
        rows = list(pool.map(lambda i: FS.logged_write(spark.range(i + 1), scratch_path(spark, f"w{i}"), "append", log), range(6)))
    assert sorted(rows) == [1, 2, 3, 4, 5, 6] and V.versions(spark, log) == list(range(6))
    assert [r["version"] for r in FS.write_history(spark, log, 2).collect()] == [5, 4]


def test_mean_shift_without_mean(spark):
    root, empty = scratch_path(spark, "amounts"), spark.createDataFrame([], "transaction_amount double")
    assert Q.mean_shift_against_stored(empty, root).first()["created"]
    later = Q.mean_shift_against_stored(spark.createDataFrame([(3.0,)], "transaction_amount double"), root).first()
    assert not later["created"] and later["shift"] is None and not later["warning"]


def test_saved_forest_scores_like_the_one_in_memory(spark):
    f = base.features_table(spark, SF_SMALL)
    model, store = M.fit_pipeline(f, M.forest(num_trees=5, max_depth=5)), scratch_path(spark, "store")
    assert M.load_model(spark, store) is None
    assert M.publish_model(spark, model, store) == 0 and M.publish_model(spark, model, store) == 1
    loaded, version = M.load_model(spark, store)
    assert version == "forest-v1" and M.load_model(spark, store, version=0)[1] == "forest-v0"
    assert M.score_batch(model, f).exceptAll(M.score_batch(loaded, f, "forest-v1")).isEmpty()
    metrics = M.evaluate(M.score_batch(loaded, f))
    assert G.model_health(G.read_runs(spark, f"{store}/runs")).first()["run_id"] is None
    G.append_run(G.training_run(metrics, "fraud-model-v1", "2024-05-01 00:00:00", 12.0, 8), f"{store}/runs")
    health = G.model_health(G.read_runs(spark, f"{store}/runs")).first()
    assert health["run_id"] == "fraud-model-v1" and abs(health["accuracy"] - metrics.first()["accuracy"]) < 1e-12


def test_attribution_of_every_row_in_groups_of_trees(spark, monkeypatch):
    f = base.features_table(spark, SF_SMALL)
    model = M.fit_pipeline(f, M.forest(num_trees=6, max_depth=6))
    f = f.withColumn("transaction_amount", F.when(F.col("transaction_id") % 50 == 0, float("nan")).otherwise(F.col("transaction_amount")))
    monkeypatch.setattr(AT, "GROUP_LEAVES", 40)
    attr = AT.forest_attribution(model.stages[-1], f, P.MODEL_FEATURES)
    total = attr.groupBy("transaction_id").agg(F.sum("phi").alias("s"), F.count("*").alias("n"))
    prob = model.transform(f).select("transaction_id", vector_to_array("probability")[1].alias("p"))
    assert total.count() == f.count() and total.join(prob, "transaction_id").where("abs(s - p) > 1e-9 or n <> 10").isEmpty()


def test_store_is_named_by_the_tables(spark):
    assert q_modelling._store(spark, "a") != q_modelling._store(spark, "b") and q_modelling._store(spark, "a") == q_modelling._store(spark, "a")
