"""Registered queries: split, scaling, training, comparison, scoring."""

from __future__ import annotations

import hashlib
import time
from datetime import datetime, timezone

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import params as P
from ..operators import attribution as AT
from ..operators import green as G
from ..operators import modelling as M
from ..session import ensure_checkpoint_dir, materialize
from . import base
from .registry import register, rounded
from .sqlbase import with_features_and

SPLIT_SQL = ("split AS (select *, case when row_number() over (partition by is_fraud order by "
             "((transaction_id % 104729) * 7919) % 104729, transaction_id) <= ceil(cast(0.2 as double) * count(*) over "
             "(partition by is_fraud)) then 'test' else 'train' end as split from features)")


def split_features(spark, sf):
    return M.stratified_split(base.features_table(spark, sf))


@register("stratified_split", with_features_and(SPLIT_SQL, "select transaction_id, is_fraud, split from split"))
def stratified_split(spark, sf):
    """M1: exact, repeatable stratified 80/20 split."""
    return split_features(spark, sf).select("transaction_id", "is_fraud", "split")


def _scale_sql() -> str:
    fs = P.MODEL_FEATURES
    stats = ", ".join(f"avg({f}) as mu_{f}, stddev_pop({f}) as sd_{f}" for f in fs)
    cols = ", ".join(f"round(({f} - mu_{f}) / case when sd_{f} = 0 then 1.0 else sd_{f} end, 6) as {f}" for f in fs)
    return with_features_and(SPLIT_SQL + f",\nst AS (select {stats} from split where split = 'train')",
                             f"select transaction_id, {cols} from split cross join st where split = 'test'")


@register("standard_scale", _scale_sql())
def standard_scale(spark, sf):
    """M2: standardise the model features with train statistics (population
    std), applied to the test rows."""
    s = split_features(spark, sf)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    stats = M.fit_scaler(train, P.MODEL_FEATURES)
    return rounded(M.apply_scaler(test.select("transaction_id", *P.MODEL_FEATURES), stats, P.MODEL_FEATURES))


def _store(spark, sf: str) -> str:
    """This application's model store for the tables under ``sf``, in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{spark.sparkContext.applicationId}/{hashlib.sha256(sf.encode()).hexdigest()[:16]}"


def held_out(spark, sf: str, split=None):
    """The test rows with the model features, written once; of a ``split``
    that is written already."""
    test = (split_features(spark, sf) if split is None else split).where(F.col("split") == "test")
    return materialize(test.select("transaction_id", "is_fraud", *P.MODEL_FEATURES), "test")


def train_and_publish(spark, sf: str):
    """Train on the training rows, save the forest as the store's next version,
    evaluate the saved one on the test rows and append the run to the register;
    the metrics row and the split."""
    begun, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    s = materialize(split_features(spark, sf), "split")
    model = M.fit_pipeline(s.where(F.col("split") == "train"), M.forest())
    version = M.publish_model(spark, model, _store(spark, sf))
    scored = materialize(M.score_batch(model, M.spread(s.where(F.col("split") == "test"))), "scored")
    metrics = materialize(M.evaluate(scored), "metrics")
    run = G.training_run(metrics, f"fraud-model-v{version}", begun, time.monotonic() - clock, spark.sparkContext.defaultParallelism)
    G.append_run(run, f"{_store(spark, sf)}/runs")
    return metrics, s


@register("train_forest")
def train_forest(spark, sf):
    """M3 + M11: forest of 200 trees, depth 15, balanced weights, published as
    a version of the model store; test metrics, also appended to the run
    register."""
    return rounded(train_and_publish(spark, sf)[0])


@register("batch_scoring")
def batch_scoring(spark, sf):
    """M6: the saved forest (the newest version of the store; trained and
    published first where there is none) scores the held-out rows: prediction,
    probability to 4 places, tier and model version."""
    split = train_and_publish(spark, sf)[1] if M.load_model(spark, _store(spark, sf)) is None else None
    model, version = M.load_model(spark, _store(spark, sf))
    return M.score_batch(model, M.spread(held_out(spark, sf, split)), version).drop("score")


@register("trained_model_health")
def trained_model_health(spark, sf):
    """M11 + F17: health from the run register that training appends to."""
    register_path = f"{_store(spark, sf)}/runs"
    if G.read_runs(spark, register_path).isEmpty():
        train_and_publish(spark, sf)
    return rounded(G.model_health(G.read_runs(spark, register_path)))


@register("model_comparison")
def model_comparison(spark, sf):
    """M4: logistic regression, gradient boosting and the forest on
    standardised features under stratified 5-fold cross-validation; mean
    accuracy and positive-class F1."""
    return rounded(M.model_comparison(base.features_table(spark, sf)))


@register("model_matrix", with_features_and(SPLIT_SQL, "select transaction_id, is_fraud, " + ", ".join(
    f"round(cast({c} as double), 6) as {c}" for c in P.MODEL_FEATURES) + " from features"))
def model_matrix(spark, sf):
    """The nine model features in their fixed order, read back from the
    assembled vector."""
    vector = vector_to_array("features")
    m = M.model_matrix(base.features(spark, sf))
    return rounded(m.select("transaction_id", "is_fraud", *[vector[i].alias(c) for i, c in enumerate(P.MODEL_FEATURES)]))


@register("bounded_sample")
def bounded_sample(spark, sf):
    """K8: a repeatable sample of at most 200 held-out rows (seeded hash,
    smallest 200), as used for attribution reports."""
    s = split_features(spark, sf)
    return M.bounded_sample(s.where(F.col("split") == "test"), 200).select("transaction_id", "is_fraud", "split")


@register("tree_attribution")
def tree_attribution(spark, sf):
    """M7: exact tree attribution of the saved forest for every held-out row:
    one row per (transaction, feature) plus the base value; the sum of phi and
    base is the predicted probability."""
    split = train_and_publish(spark, sf)[1] if M.load_model(spark, _store(spark, sf)) is None else None
    model, _ = M.load_model(spark, _store(spark, sf))
    return rounded(AT.forest_attribution(model.stages[-1], M.spread(held_out(spark, sf, split)), P.MODEL_FEATURES))
