"""Registered queries: evaluation of the rule model's predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_to

from ..operators import evaluation as E
from . import base
from .registry import register, rounded
from .sqlbase import with_scored

CM = ("count(*) filter (where is_fraud = 0 and prediction = 0) as tn, "
      "count(*) filter (where is_fraud = 0 and prediction = 1) as fp, "
      "count(*) filter (where is_fraud = 1 and prediction = 0) as fn, "
      "count(*) filter (where is_fraud = 1 and prediction = 1) as tp")


def _metrics_sql(src: str, by: str = "") -> str:
    """Metric columns over a confusion-count relation ``src``."""
    sel = f"{by}, " if by else ""
    return (
        f"select {sel}n, round(case when n > 0 then (tp + tn) / n else 0.0 end, 6) as accuracy, "
        "round(prec, 6) as precision, round(rec, 6) as recall, "
        "round(case when fp + tn > 0 then fp / (fp + tn) else 0.0 end, 6) as false_positive_rate, "
        "round(case when prec + rec > 0 then 2 * prec * rec / (prec + rec) else 0.0 end, 6) as f1_score, tn, fp, fn, tp "
        f"from (select *, tn + fp + fn + tp as n, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as prec, "
        f"case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as rec from ({src}))"
    )


METRICS_SQL = _metrics_sql(f"select {CM} from scored")


@register("labelled_predictions", with_scored(
    "select p.transaction_id, l.is_fraud, p.prediction, round(p.score, 6) as score from "
    "(select transaction_id, prediction, score from scored) p join "
    "(select transaction_id, is_fraud from transactions) l on p.transaction_id = l.transaction_id"))
def labelled_predictions(spark, sf):
    """Labels joined to predictions on the transaction id."""
    preds = base.scored(spark, sf).select("transaction_id", "prediction", round_to(F.col("score"), 6).alias("score"))
    labels = base.tx(spark, sf).select("transaction_id", "is_fraud")
    return preds.join(labels, "transaction_id")


@register("confusion_matrix", with_scored(f"select {CM} from scored"))
def confusion_matrix(spark, sf):
    """Tn / fp / fn / tp in one pass."""
    return E.confusion_matrix(base.scored(spark, sf))


@register("classification_metrics", with_scored(METRICS_SQL))
def classification_metrics(spark, sf):
    """A10: accuracy, precision, recall, FPR, F1 (0 on empty denominators)."""
    m = E.classification_metrics(base.scored(spark, sf))
    return rounded(m.select("n", "accuracy", "precision", "recall", "false_positive_rate", "f1_score",
                            "tn", "fp", "fn", "tp"))


@register("cost_analysis", with_scored(
    f"select fp, fn, fp * cast(5.0 as double) as false_positive_cost, fn * cast(250.0 as double) as false_negative_cost, "
    f"fp * cast(5.0 as double) + fn * cast(250.0 as double) as total_cost from (select {CM} from scored)"))
def cost_analysis(spark, sf):
    """FP × 5 + FN × 250."""
    return E.cost_analysis(base.scored(spark, sf))


@register("roc_auc", with_scored(
    "select n_pos, n_neg, round((sr - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg), 6) as roc_auc from ("
    "select count(*) filter (where is_fraud = 1) as n_pos, count(*) filter (where is_fraud = 0) as n_neg, "
    "sum(case when is_fraud = 1 then mr end) as sr from ("
    "select is_fraud, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as mr "
    "from scored where score is not null))"))
def roc_auc(spark, sf):
    """Exact ROC AUC with mid-ranks for tied scores."""
    return rounded(E.roc_auc(base.scored(spark, sf)))


@register("fpr_by_group", with_scored(
    "select age_band, n, round(case when fp + tn > 0 then fp / (fp + tn) else 0.0 end, 6) as fpr from "
    f"(select age_band, count(*) as n, {CM} from scored group by age_band)"))
def fpr_by_group(spark, sf):
    """False-positive rate per age band."""
    return rounded(E.fpr_by_group(base.scored(spark, sf)))


@register("fairness_gate", with_scored(
    "select 'fairness' as policy, count(*) as n_groups, round(max(fpr), 6) as max_fpr, round(min(fpr), 6) as min_fpr, "
    "(select age_band from g order by fpr desc, age_band desc limit 1) as worst_group, "
    "(select age_band from g order by fpr asc, age_band asc limit 1) as best_group, "
    "round(coalesce(max(fpr) - min(fpr), 0.0), 6) as disparity, cast(0.1 as double) as threshold, "
    "coalesce(max(fpr) - min(fpr), 0.0) <= 0.1 as passed, "
    "case when count(*) = 0 then 'skipped' when coalesce(max(fpr) - min(fpr), 0.0) <= 0.1 then 'passed' else 'failed' end as status from g",
    "g AS (select age_band, case when fp + tn > 0 then fp / (fp + tn) else 0.0 end as fpr from "
    f"(select age_band, {CM} from scored group by age_band))"))
def fairness_gate(spark, sf):
    """FPR disparity across age bands ≤ 0.1."""
    return rounded(E.fairness_gate(base.scored(spark, sf)))


@register("deployment_decision", with_scored(
    "select n, accuracy, false_positive_rate, d as decision, d = 'deploy_model' as promoted from ("
    "select *, case when n = 0 then 'skip_deployment' when accuracy >= 0.88 and false_positive_rate <= 0.08 "
    f"then 'deploy_model' else 'flag_for_review' end as d from ({METRICS_SQL}))"))
def deployment_decision(spark, sf):
    """Deploy when accuracy ≥ .88 and FPR ≤ .08, else review."""
    return rounded(E.deployment_decision(E.classification_metrics(base.scored(spark, sf))))


@register("rollback_check", with_scored(
    "select round(o, 6) as old_fpr, round(nw, 6) as new_fpr, nw > o * 1.5 as rollback from ("
    "select max(case when cohort = 'baseline' then f end) as o, max(case when cohort = 'current' then f end) as nw from ("
    "select cohort, case when fp + tn > 0 then fp / (fp + tn) else 0.0 end as f from "
    f"(select cohort, {CM} from scored group by cohort)))"))
def rollback_check(spark, sf):
    """G8 (documented rule): roll back if the new FPR > 1.5 × the old one."""
    return rounded(E.rollback_check(base.scored(spark, sf)))


@register("metric_targets", with_scored(
    f"select 'accuracy' as metric, accuracy as actual, cast(0.924 as double) as target, accuracy >= 0.924 as meets from ({METRICS_SQL}) "
    f"union all select 'false_positive_rate', false_positive_rate, 0.051, false_positive_rate <= 0.051 from ({METRICS_SQL})"))
def metric_targets(spark, sf):
    """Actual metrics against the target table."""
    return rounded(E.metric_targets(E.classification_metrics(base.scored(spark, sf))))


@register("class_weights", with_scored(
    "select is_fraud, count(*) as n_class, round((select count(*) from scored) / (2.0 * count(*)), 6) as weight "
    "from scored group by is_fraud"))
def class_weights(spark, sf):
    """M5: balanced class weights n / (2 · n_class)."""
    return rounded(E.class_weights(base.tx(spark, sf)))
