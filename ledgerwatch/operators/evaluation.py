"""Evaluation of predictions: confusion matrix, derived rates, cost, exact
ROC AUC, per-group false-positive rates and the decision gates built on
them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .windows import prefix_sums


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (as the reference's metrics)."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def confusion_counts(y: str = "is_fraud", pred: str = "prediction") -> list[Column]:
    yc, pc = F.col(y), F.col(pred)
    return [
        F.count_if((yc == 0) & (pc == 0)).alias("tn"),
        F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"),
        F.count_if((yc == 1) & (pc == 1)).alias("tp"),
    ]


def confusion_matrix(df: DataFrame, y: str = "is_fraud", pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Tn, fp, fn, tp in one pass (optionally per group)."""
    return df.groupBy(*(by or [])).agg(*confusion_counts(y, pred))


def metrics_from_counts(cm: DataFrame) -> DataFrame:
    """A10 on top of confusion counts: accuracy, precision, recall (TPR),
    false-positive rate and F1, each 0 when its denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec, rec = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return cm.withColumn("n", n).withColumn("accuracy", ratio(tp + tn, n)) \
        .withColumn("precision", prec).withColumn("recall", rec) \
        .withColumn("false_positive_rate", ratio(fp, fp + tn)) \
        .withColumn("f1_score", F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)))


def classification_metrics(df: DataFrame, y: str = "is_fraud", pred: str = "prediction",
                           by: list[str] | None = None) -> DataFrame:
    return metrics_from_counts(confusion_matrix(df, y, pred, by))


def cost_analysis(df: DataFrame, y: str = "is_fraud", pred: str = "prediction",
                  cost_fp: float = P.COST_PER_FP, cost_fn: float = P.COST_PER_FN) -> DataFrame:
    """False positives × cost_fp + false negatives × cost_fn."""
    cm = confusion_matrix(df, y, pred)
    return cm.select("fp", "fn", (F.col("fp") * cost_fp).alias("false_positive_cost"),
                     (F.col("fn") * cost_fn).alias("false_negative_cost"),
                     (F.col("fp") * cost_fp + F.col("fn") * cost_fn).alias("total_cost"))


def roc_auc(df: DataFrame, y: str = "is_fraud", score: str = "score") -> DataFrame:
    """Exact ROC AUC (Mann–Whitney with mid-ranks for ties).

    Rows are first reduced to one row per distinct score (partial
    aggregation). The count of negatives below each score is a distributed
    prefix sum over ranges of scores that hold about equally many of them, so
    no task orders the whole table, wherever the scores lie.
    """
    d = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(score).alias("_score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    d = prefix_sums(d, [], [F.col("_score")], ["neg"], "auc")
    lt = F.col("_before_neg")
    tot = d.agg(
        F.sum(F.col("pos").cast("double") * (lt.cast("double") + F.col("neg") * 0.5)).alias("_u"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    den = F.col("n_pos").cast("double") * F.col("n_neg")
    return tot.select(F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"),
                      F.when(den > 0, F.col("_u") / den).alias("roc_auc"))


def fpr_by_group(df: DataFrame, group: str = "age_band", y: str = "is_fraud", pred: str = "prediction") -> DataFrame:
    """False-positive rate per group."""
    cm = confusion_matrix(df, y, pred, [group])
    return cm.select(group, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"),
                     ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"))


def fairness_gate(df: DataFrame, group: str = "age_band", threshold: float = P.FAIRNESS_THRESHOLD,
                  y: str = "is_fraud", pred: str = "prediction") -> DataFrame:
    """FPR disparity (max − min over groups) against the threshold; no
    groups → passed, with status ``skipped``."""
    g = fpr_by_group(df, group, y, pred)
    hi = F.max(F.struct(F.col("fpr"), F.col(group)))
    lo = F.min(F.struct(F.col("fpr"), F.col(group)))
    agg = g.agg(F.count(F.lit(1)).alias("n_groups"), hi.alias("_hi"), lo.alias("_lo"))
    disparity = F.coalesce(F.col("_hi.fpr") - F.col("_lo.fpr"), F.lit(0.0))
    passed = disparity <= F.lit(threshold)
    return agg.select(
        F.lit("fairness").alias("policy"), "n_groups",
        F.col("_hi.fpr").alias("max_fpr"), F.col("_lo.fpr").alias("min_fpr"),
        F.col(f"_hi.{group}").alias("worst_group"), F.col(f"_lo.{group}").alias("best_group"),
        disparity.alias("disparity"), F.lit(threshold).alias("threshold"), passed.alias("passed"),
        F.when(F.col("n_groups") == 0, "skipped").when(passed, "passed").otherwise("failed").alias("status"))


def deployment_decision(metrics: DataFrame, min_accuracy: float = P.MIN_MODEL_ACCURACY,
                        max_fpr: float = P.MAX_FALSE_POSITIVE_RATE) -> DataFrame:
    """G3/G4 on a metrics row: deploy when accuracy ≥ min and FPR ≤ max,
    else flag for review; no predictions → skip."""
    acc, fpr = F.col("accuracy"), F.col("false_positive_rate")
    decision = (F.when(F.col("n") == 0, "skip_deployment")
                .when((acc >= min_accuracy) & (fpr <= max_fpr), "deploy_model")
                .otherwise("flag_for_review"))
    return metrics.select("n", "accuracy", "false_positive_rate", decision.alias("decision"),
                          (decision == "deploy_model").alias("promoted"))


def rollback_check(df: DataFrame, cohort: str = "cohort", old: str = "baseline", new: str = "current",
                   factor: float = P.ROLLBACK_FPR_FACTOR) -> DataFrame:
    """Roll back when the new cohort's FPR exceeds factor × the old one."""
    g = classification_metrics(df, by=[cohort])
    agg = g.agg(F.max(F.when(F.col(cohort) == old, F.col("false_positive_rate"))).alias("old_fpr"),
                F.max(F.when(F.col(cohort) == new, F.col("false_positive_rate"))).alias("new_fpr"))
    return agg.select("old_fpr", "new_fpr", (F.col("new_fpr") > F.col("old_fpr") * factor).alias("rollback"))


def metric_targets(metrics: DataFrame, target_accuracy: float = P.TARGET_ACCURACY,
                   target_fpr: float = P.TARGET_FPR) -> DataFrame:
    """Actual against target, one row per metric."""
    return metrics.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("actual"),
                 F.lit(target_accuracy).alias("target"), (F.col("accuracy") >= target_accuracy).alias("meets")),
        F.struct(F.lit("false_positive_rate").alias("metric"), F.col("false_positive_rate").alias("actual"),
                 F.lit(target_fpr).alias("target"), (F.col("false_positive_rate") <= target_fpr).alias("meets")),
    )))


def class_weights(df: DataFrame, y: str = "is_fraud") -> DataFrame:
    """M5: balanced weights n / (2 · n_class), one row per class."""
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("n_class"))
    total = counts.agg(F.sum("n_class").alias("n_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        y, "n_class", (F.col("n_total") / (F.lit(2.0) * F.col("n_class"))).alias("weight"))
