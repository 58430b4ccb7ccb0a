"""Dashboard analytics over scored transactions: KPI impact, period trend,
segment × region cells, hourly volume, latency SLA, live feed and region
insights. All are group-by aggregates with partial aggregation; second-level
steps work on the (small) aggregated rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import params as P
from ..functions.numeric import round_to
from ..session import materialize
from . import features as FE
from .evaluation import confusion_counts, ratio


def kpi_summary(scored: DataFrame, baseline_fpr: float = P.BASELINE_FPR, cost_per_fp: float = P.COST_PER_FP) -> DataFrame:
    """False-positive reduction against a baseline FPR, savings and the
    amount of fraud prevented (sum of amounts over true positives)."""
    agg = scored.agg(
        F.count(F.lit(1)).alias("transactions"), *confusion_counts(),
        F.sum(F.when((F.col("is_fraud") == 1) & (F.col("prediction") == 1), F.col("transaction_amount")))
        .alias("_prevented"))
    fpr = ratio(F.col("fp"), F.col("fp") + F.col("tn"))
    n = F.col("transactions").cast("double")
    fp_reduction = n * baseline_fpr - n * fpr
    savings = fp_reduction * cost_per_fp
    return agg.select(
        "transactions", fpr.alias("current_fpr"), F.lit(baseline_fpr).alias("baseline_fpr"),
        fp_reduction.alias("fp_reduction"), savings.alias("monthly_savings"), (savings * 12).alias("annual_roi"),
        F.coalesce(F.col("_prevented"), F.lit(0.0)).alias("fraud_prevented"),
        ((F.lit(baseline_fpr) - fpr) / F.lit(baseline_fpr) * 100).alias("fpr_reduction_pct"))


def kpi_trend(scored: DataFrame, unit: str = "week", ts: str = "transaction_timestamp") -> DataFrame:
    """A21 + W7: per period, transactions, fraud prevented and false
    positives, with the change against the previous period in percent."""
    per = scored.groupBy(F.date_trunc(unit, ts).alias("period_start")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.coalesce(F.sum(F.when((F.col("is_fraud") == 1) & (F.col("prediction") == 1), F.col("transaction_amount"))),
                   F.lit(0.0)).alias("fraud_prevented"),
        F.count_if((F.col("is_fraud") == 0) & (F.col("prediction") == 1)).alias("false_positives"))
    # One row per period: a global order over a bounded number of rows.
    prev = F.lag("fraud_prevented").over(Window.orderBy("period_start"))
    return per.withColumn("fraud_prevented_change_pct",
                          F.when(prev != 0, (F.col("fraud_prevented") - prev) / prev * 100))


def fpr_band(c):
    return F.when(c < 0.40, "green").when(c < 0.70, "amber").when(c < 1.00, "orange").otherwise("red")


def fnr_band(c):
    return F.when(c > 3.0, "green").when(c > 2.0, "amber").when(c > 1.5, "orange").otherwise("red")


def segment_cells(scored: DataFrame, segment: str = "customer_segment", region: str = "region") -> DataFrame:
    """A22 + P14: one row per (segment, region): FPR and FNR in percent,
    counts, detected fraud, false positives and the display bands."""
    cm = scored.groupBy(segment, region).agg(F.count(F.lit(1)).alias("transaction_count"), *confusion_counts())
    fpr = ratio(F.col("fp"), F.col("fp") + F.col("tn")) * 100
    fnr = ratio(F.col("fn"), F.col("fn") + F.col("tp")) * 100
    return cm.select(F.col(segment).alias("segment"), F.col(region).alias("region"), "transaction_count",
                     F.col("tp").alias("fraud_detected"), F.col("fp").alias("false_positives"),
                     fpr.alias("fpr_pct"), fnr.alias("fnr_pct"), fpr_band(fpr).alias("fpr_band"),
                     fnr_band(fnr).alias("fnr_band"))


def segment_matrix(scored: DataFrame, regions: list[str] = P.REGIONS) -> DataFrame:
    """One row per segment, one FPR column per region (pivot with the
    region list given, so no extra pass to discover it)."""
    cm = scored.groupBy("customer_segment").pivot("region", regions).agg(
        (F.count_if((F.col("is_fraud") == 0) & (F.col("prediction") == 1))
         / F.greatest(F.count_if(F.col("is_fraud") == 0), F.lit(1)) * 100))
    return cm.withColumnRenamed("customer_segment", "segment")


def segment_overall(cells: DataFrame) -> DataFrame:
    """Total transactions, unweighted mean of cell FPRs, highest and
    lowest cell (ties broken by name)."""
    name = F.concat_ws(" - ", "segment", "region")
    return cells.agg(
        F.sum("transaction_count").alias("total_transactions"), F.avg("fpr_pct").alias("average_fpr_pct"),
        F.max(F.struct(F.col("fpr_pct"), name.alias("n"))).alias("_hi"),
        F.min(F.struct(F.col("fpr_pct"), name.alias("n"))).alias("_lo"),
    ).select("total_transactions", "average_fpr_pct", F.col("_hi.n").alias("highest_fpr_segment"),
             F.col("_lo.n").alias("lowest_fpr_segment"))


def segment_rollup(scored: DataFrame) -> DataFrame:
    """Cells plus per-segment and grand totals (rollup)."""
    return scored.rollup("customer_segment", "region").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if((F.col("is_fraud") == 0) & (F.col("prediction") == 1)).alias("false_positives"),
        F.count_if((F.col("is_fraud") == 1) & (F.col("prediction") == 1)).alias("fraud_detected"),
        F.grouping_id().alias("level"))


def hourly_volume(scored: DataFrame, ts: str = "transaction_timestamp", latency: str = "processing_time_ms") -> DataFrame:
    """Per hour: volume, mean latency, flagged fraud, mean amount."""
    return scored.groupBy(F.date_trunc("hour", ts).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("volume"), F.avg(latency).alias("latency_ms"),
        F.sum("prediction").cast("bigint").alias("fraud_detected"), F.avg("transaction_amount").alias("avg_amount")
    ).withColumn("hour", F.date_format("hour_start", "HH:00"))


def volume_summary(hourly: DataFrame) -> DataFrame:
    """Totals over the hourly series and its peak hour (earliest on ties)."""
    return hourly.agg(
        F.sum("volume").alias("total_transactions"), F.avg("latency_ms").alias("avg_latency_ms"),
        F.sum("fraud_detected").alias("total_fraud_detected"),
        (F.sum("fraud_detected") / F.sum("volume") * 100).alias("fraud_rate_pct"),
        F.max(F.struct(F.col("volume"), F.col("hour_start").cast("timestamp").cast("long") * -1, F.col("hour_start").alias("h")))
        .alias("_peak"),
    ).select("total_transactions", "avg_latency_ms", "total_fraud_detected", "fraud_rate_pct",
             F.col("_peak.h").alias("peak_hour_start"), F.col("_peak.volume").alias("peak_volume"))


QUANTILE_BINS = 4096       # of a round of selection
QUANTILE_LEFT = 65_536     # candidates left that one task sorts


def _kth(values: DataFrame, k: int, lo: float, hi: float) -> float:
    """The k-th smallest (from 0) of the finite doubles ``v`` of ``values``,
    which lie in [lo, hi]: each round counts equal bins of the range and goes on
    with the least and largest value of the bin that holds the k-th."""
    while lo < hi:
        inside = values.where(F.col("v").between(lo, hi))
        # halves keep the width of any two finite doubles finite
        share = (F.col("v") / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) if hi / 2 > lo / 2 else F.when(F.col("v") > lo, 1.0).otherwise(0.0)
        bins = inside.groupBy(F.least(F.floor(share * QUANTILE_BINS), F.lit(QUANTILE_BINS - 1)).alias("b")).agg(
            F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for b in sorted(bins.collect(), key=lambda r: r["b"]):       # at most QUANTILE_BINS rows
            if k < b["n"]:
                break
            k -= b["n"]
        lo, hi = b["lo"], b["hi"]
        if b["n"] <= QUANTILE_LEFT and lo < hi:
            left = values.where(F.col("v").between(lo, hi)).groupBy("v").agg(F.count("*").alias("n")).selectExpr("v", "sum(n) over (order by v) as upto")
            return left.where(F.col("upto") > k).agg(F.min("v")).first()[0]
    return lo


def exact_quantile(df: DataFrame, col: str, q: float) -> DataFrame:
    """One row ``value``: the continuous (linearly interpolated) quantile of a
    numeric column read as doubles, exact; nulls don't count, NaN is the largest
    value, the quantile of nothing is null.

    Selection by repeated histograms: every round is a partial aggregation into
    at most 4,096 bins, and no task orders more than 65,536 values. The column
    is written once, as several rounds read it."""
    spark = df.sparkSession
    values = materialize(df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v")), "values")
    finite = ~F.isnan("v") & (F.abs("v") < float("inf"))
    st = values.agg(F.count("*").alias("n"), F.count_if(F.col("v") == float("-inf")).alias("down"), F.count_if(finite).alias("finite"),
                    F.count_if(F.col("v") == float("inf")).alias("up"), F.min(F.when(finite, F.col("v"))).alias("lo"), F.max(F.when(finite, F.col("v"))).alias("hi")).first()
    if not st["n"]:
        return spark.createDataFrame([(None,)], "value double")

    def at(k: int) -> float:
        if k < st["down"]:
            return float("-inf")
        if k < st["down"] + st["finite"]:
            return _kth(values.where(finite), k - st["down"], st["lo"], st["hi"])
        return float("inf") if k < st["down"] + st["finite"] + st["up"] else float("nan")

    h = (st["n"] - 1) * q
    low = at(math.floor(h))
    value = low
    if h > math.floor(h):
        high = at(math.floor(h) + 1)
        value = low if low == high else low + (h - math.floor(h)) * (high - low)
    return spark.createDataFrame([(float(value),)], "value double")


def sla_compliance(scored: DataFrame, latency: str = "processing_time_ms", target: float = P.SLA_TARGET_MS,
                   pct: float = P.SLA_PERCENTILE) -> DataFrame:
    """Exact p95 latency (equal to SQL's continuous quantile) against
    the target, plus the mean latency."""
    p95 = exact_quantile(scored, latency, pct).select(F.col("value").alias("p95_latency_ms"))
    mean = scored.agg(F.avg(latency).alias("avg_latency_ms"))
    return p95.crossJoin(mean).select(
        F.lit(target).alias("target_latency_ms"), "p95_latency_ms", "avg_latency_ms",
        (F.col("p95_latency_ms") < target).alias("sla_met"))


def live_feed(scored: DataFrame, n: int = 20, ts: str = "transaction_timestamp") -> DataFrame:
    """K5: the newest ``n`` transactions (top-k, no global sort)."""
    return scored.orderBy(F.col(ts).desc(), F.col("transaction_id")).limit(n).select(
        "transaction_id", "customer_id", ts, "transaction_amount", "merchant_category",
        F.when(F.col("prediction") == 1, "FRAUD").otherwise("LEGIT").alias("prediction"),
        round_to(F.col("score"), 4).alias("fraud_probability"), "processing_time_ms")


def newest_scored(tx: DataFrame, n: int = 20, ts: str = "transaction_timestamp") -> DataFrame:
    """Scored transactions that hold the newest ``n`` of all: these are picked
    first, and features are computed over the history of their customers only
    (at most ``n`` keys, broadcast), as a row's features depend on its own
    customer alone."""
    newest = materialize(tx.orderBy(F.col(ts).desc(), F.col("transaction_id")).limit(n).select(F.col("customer_id").alias("_customer")), "newest").distinct()
    history = tx.join(F.broadcast(newest), F.col("customer_id").eqNullSafe(F.col("_customer")), "left_semi")
    return FE.score(FE.engineer_features(history))


def live_feed_summary(feed: DataFrame) -> DataFrame:
    """A29 + P12: counts by prediction and mean latency (0 when empty)."""
    return feed.agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(F.col("prediction") == "FRAUD").alias("fraud_count"),
        F.count_if(F.col("prediction") == "LEGIT").alias("legit_count"),
        F.coalesce(round_to(F.avg("processing_time_ms"), 1), F.lit(0.0)).alias("avg_processing_time_ms"))


def region_insights(scored: DataFrame, reference_region: str = "Domestic") -> DataFrame:
    """FPR per region and its ratio to the reference region's FPR."""
    g = scored.groupBy("region").agg(*confusion_counts())
    g = g.select("region", ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"))
    # One row per region: the reference row is spread with a windowless max.
    ref = F.max(F.when(F.col("region") == reference_region, F.col("fpr"))).over(Window.partitionBy(F.lit(1)))
    return g.withColumn("fpr_ratio_to_domestic", F.when(ref > 0, F.col("fpr") / ref))
