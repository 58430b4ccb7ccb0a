"""Registered queries: the streaming jobs, run with ``availableNow`` over
batches landed from the driver tables; each equals its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..sources.tables import TRANSACTIONS_SCHEMA
from ..streaming import jobs as S
from . import base
from .q_analytics import HOURLY
from .q_drift import DAILY_BODY, EDGES, hist_ctes
from .q_features import TIER_SQL, TX_COLS
from .registry import register, rounded
from .sqlbase import with_scored, with_tx


@register("stream_ingest", with_tx(f"select {TX_COLS} from transactions"))
def stream_ingest(spark, sf):
    """Arriving batches ingested by a stream; equals the batch table."""
    src, out, ckpt = S.new_paths(spark, "ingest")
    for _ in S.land(base.tx(spark, sf), src, "transaction_id", 4):
        raw = S.stream_ingest(spark, src, TRANSACTIONS_SCHEMA, out, ckpt)
    return raw


@register("stream_hourly_volume", with_scored(
    "select hour_start, volume, round(latency_ms, 6) as latency_ms, fraud_detected, round(avg_amount, 6) as avg_amount "
    f"from ({HOURLY})"))
def stream_hourly_volume(spark, sf):
    """Hourly volume as a watermarked tumbling-window stream over four
    arrivals in time order; an hour that two arrivals share is updated."""
    scored = S.materialize(base.scored(spark, sf).select("transaction_timestamp", "processing_time_ms", "prediction", "transaction_amount"), "scored")
    src, out, ckpt = S.new_paths(spark, "hourly")
    for _ in S.land(scored, src, S.time_slices(scored, "transaction_timestamp", 4), 4):
        table = S.run_hourly_volume(spark, src, scored.schema, out, ckpt)
    return rounded(table)


@register("stream_scoring", with_scored(
    f"select transaction_id, prediction, round(score, 4) as fraud_probability, {TIER_SQL} as risk_level, "
    "'rule-v1.0' as model_version from scored"))
def stream_scoring(spark, sf):
    """Arriving feature rows scored by a stateless stream."""
    f = FE.engineer_features(base.tx(spark, sf))
    src, out, ckpt = S.new_paths(spark, "scoring")
    for _ in S.land(f, src, "transaction_id", 4):
        scores = S.run_scoring(spark, src, f.schema, out, ckpt)
    return rounded(scores)


BATCH_CTES = [EDGES, *hist_ctes(10, "'b'", "hb", "cohort = 'baseline'"), *hist_ctes(10, "transaction_id % 4", "hd", "cohort = 'current'"),
              *hist_ctes(20, "'b'", "kb", "cohort = 'baseline'"), *hist_ctes(20, "transaction_id % 4", "kd", "cohort = 'current'")]


@register("stream_drift", with_scored(
    "select cast(report_date as bigint) as batch_id, n, round(psi, 6) as psi, round(kl_divergence, 6) as kl_divergence, "
    "round(current_mean, 6) as current_mean, drift_detected, severity from ("
    + DAILY_BODY.replace("cast(transaction_timestamp as date)", "transaction_id % 4").replace("'drift_' || strftime(d.grp, '%Y%m%d') as report_id, ", "")
    + ")", *BATCH_CTES))
def stream_drift(spark, sf):
    """T4: one drift report per micro-batch of current-cohort scores against
    the stored baseline cohort."""
    s = base.scored(spark, sf).select("transaction_id", "score", "cohort")
    baseline_dir = S.scratch_path(spark, "baseline-scores")
    s.where(F.col("cohort") == "baseline").write.parquet(baseline_dir)
    baseline = spark.read.parquet(baseline_dir)
    src, out, ckpt = S.new_paths(spark, "drift")
    cur = s.where(F.col("cohort") == "current")
    for _ in S.land(cur, src, "transaction_id", 4):
        reports = S.run_drift_per_batch(spark, baseline, src, cur.schema, out, ckpt)
    return rounded(reports)
