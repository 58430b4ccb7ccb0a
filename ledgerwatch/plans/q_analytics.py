"""Registered queries: dashboard analytics over scored transactions."""

from __future__ import annotations

from ..operators import analytics as A
from . import base
from .registry import register, rounded
from .sqlbase import with_scored

CM = ("count(*) filter (where is_fraud = 0 and prediction = 0) as tn, "
      "count(*) filter (where is_fraud = 0 and prediction = 1) as fp, "
      "count(*) filter (where is_fraud = 1 and prediction = 0) as fn, "
      "count(*) filter (where is_fraud = 1 and prediction = 1) as tp")
FPR = "case when fp + tn > 0 then fp / (fp + tn) else 0.0 end"
FNR = "case when fn + tp > 0 then fn / (fn + tp) else 0.0 end"


def band_sql(c: str, kind: str) -> str:
    if kind == "fpr":
        return (f"case when {c} < 0.40 then 'green' when {c} < 0.70 then 'amber' when {c} < 1.00 then 'orange' "
                "else 'red' end")
    return f"case when {c} > 3.0 then 'green' when {c} > 2.0 then 'amber' when {c} > 1.5 then 'orange' else 'red' end"


@register("kpi_summary", with_scored(
    "select transactions, round(f, 6) as current_fpr, cast(0.12 as double) as baseline_fpr, round(transactions * 0.12 - transactions * f, 6) "
    "as fp_reduction, round((transactions * 0.12 - transactions * f) * 5.0, 6) as monthly_savings, "
    "round((transactions * 0.12 - transactions * f) * 5.0 * 12, 6) as annual_roi, round(coalesce(p, 0.0), 6) as fraud_prevented, "
    "round((0.12 - f) / 0.12 * 100, 6) as fpr_reduction_pct from ("
    f"select transactions, {FPR} as f, p from (select count(*) as transactions, {CM}, "
    "sum(case when is_fraud = 1 and prediction = 1 then transaction_amount end) as p from scored))"))
def kpi_summary(spark, sf):
    """A20 (re-aimed): KPI impact computed from the scored rows."""
    return rounded(A.kpi_summary(base.scored(spark, sf)))


@register("kpi_trend", with_scored(
    "select period_start, transactions, round(fraud_prevented, 6) as fraud_prevented, false_positives, "
    "round(case when lag(fraud_prevented) over (order by period_start) <> 0 then (fraud_prevented - "
    "lag(fraud_prevented) over (order by period_start)) / lag(fraud_prevented) over (order by period_start) * 100 end, 6) "
    "as fraud_prevented_change_pct from (select date_trunc('week', transaction_timestamp) as period_start, "
    "count(*) as transactions, coalesce(sum(case when is_fraud = 1 and prediction = 1 then transaction_amount end), 0.0) "
    "as fraud_prevented, count(*) filter (where is_fraud = 0 and prediction = 1) as false_positives "
    "from scored group by 1)"))
def kpi_trend(spark, sf):
    """A21 + W7: weekly trend with week-over-week change."""
    return rounded(A.kpi_trend(base.scored(spark, sf), "week"))


CELLS = (f"select customer_segment as segment, region, transaction_count, tp as fraud_detected, fp as false_positives, "
         f"({FPR}) * 100 as fpr_pct, ({FNR}) * 100 as fnr_pct from (select customer_segment, region, "
         f"count(*) as transaction_count, {CM} from scored group by 1, 2)")


@register("segmentation_long", with_scored(
    f"select segment, region, transaction_count, fraud_detected, false_positives, round(fpr_pct, 6) as fpr_pct, "
    f"round(fnr_pct, 6) as fnr_pct, {band_sql('fpr_pct', 'fpr')} as fpr_band, {band_sql('fnr_pct', 'fnr')} as fnr_band "
    f"from ({CELLS})"))
def segmentation_long(spark, sf):
    """A22 + P14 (re-aimed): real FPR / FNR per segment × region cell."""
    return rounded(A.segment_cells(base.scored(spark, sf)))


@register("segmentation_pivot", with_scored(
    "select customer_segment as segment, "
    + ", ".join(
        f"round(count(*) filter (where region = '{r}' and is_fraud = 0 and prediction = 1) / "
        f"greatest(count(*) filter (where region = '{r}' and is_fraud = 0), 1) * 100, 6) as \"{r}\""
        for r in ["Domestic", "International", "Cross-Border"])
    + " from scored group by 1"))
def segmentation_pivot(spark, sf):
    """Segments as rows, regions as FPR columns (pivot)."""
    return rounded(A.segment_matrix(base.scored(spark, sf)))


@register("segmentation_overall", with_scored(
    "select cast(sum(transaction_count) as bigint) as total_transactions, round(avg(fpr_pct), 6) as average_fpr_pct, "
    "(select segment || ' - ' || region from c order by fpr_pct desc, segment || ' - ' || region desc limit 1) "
    "as highest_fpr_segment, (select segment || ' - ' || region from c order by fpr_pct asc, segment || ' - ' || region asc "
    "limit 1) as lowest_fpr_segment from c", f"c AS ({CELLS})"))
def segmentation_overall(spark, sf):
    """A24 (re-aimed): overall stats with the real worst and best cell."""
    return rounded(A.segment_overall(A.segment_cells(base.scored(spark, sf))))


@register("segmentation_rollup", with_scored(
    "select customer_segment, region, count(*) as transaction_count, "
    "count(*) filter (where is_fraud = 0 and prediction = 1) as false_positives, "
    "count(*) filter (where is_fraud = 1 and prediction = 1) as fraud_detected, "
    "cast(grouping(customer_segment, region) as bigint) as level from scored group by rollup(customer_segment, region)"))
def segmentation_rollup(spark, sf):
    """Segment × region cells with subtotals and the grand total."""
    return A.segment_rollup(base.scored(spark, sf))


HOURLY = ("select date_trunc('hour', transaction_timestamp) as hour_start, count(*) as volume, "
          "avg(processing_time_ms) as latency_ms, cast(sum(prediction) as bigint) as fraud_detected, "
          "avg(transaction_amount) as avg_amount, strftime(date_trunc('hour', transaction_timestamp), '%H:00') as hour "
          "from scored group by 1")


@register("hourly_volume", with_scored(
    "select hour_start, volume, round(latency_ms, 6) as latency_ms, fraud_detected, round(avg_amount, 6) as avg_amount, "
    f"hour from ({HOURLY})"))
def hourly_volume(spark, sf):
    """A26 (re-aimed): hourly volume, latency, flagged fraud, mean amount."""
    return rounded(A.hourly_volume(base.scored(spark, sf)))


@register("volume_summary", with_scored(
    "select cast(sum(volume) as bigint) as total_transactions, round(avg(latency_ms), 6) as avg_latency_ms, "
    "cast(sum(fraud_detected) as bigint) as total_fraud_detected, round(sum(fraud_detected) / sum(volume) * 100, 6) as fraud_rate_pct, "
    "(select hour_start from h order by volume desc, hour_start asc limit 1) as peak_hour_start, "
    "max(volume) as peak_volume from h", f"h AS ({HOURLY})"))
def volume_summary(spark, sf):
    """Totals, fraud rate and the peak hour."""
    return rounded(A.volume_summary(A.hourly_volume(base.scored(spark, sf))))


@register("sla_compliance", with_scored(
    "select cast(100.0 as double) as target_latency_ms, round(quantile_cont(processing_time_ms, 0.95), 6) as p95_latency_ms, "
    "round(avg(processing_time_ms), 6) as avg_latency_ms, quantile_cont(processing_time_ms, 0.95) < 100.0 as sla_met "
    "from scored"))
def sla_compliance(spark, sf):
    """A28 (re-aimed): real p95 latency against the 100 ms target."""
    return rounded(A.sla_compliance(base.scored(spark, sf)))


FEED = ("select transaction_id, customer_id, transaction_timestamp, transaction_amount, merchant_category, "
        "case when prediction = 1 then 'FRAUD' else 'LEGIT' end as prediction, round(score, 4) as fraud_probability, "
        "processing_time_ms from scored order by transaction_timestamp desc, transaction_id limit 20")


@register("live_feed", with_scored(FEED))
def live_feed(spark, sf):
    """K5 (re-aimed): the 20 newest scored transactions."""
    return A.live_feed(A.newest_scored(base.tx(spark, sf)))


@register("live_feed_summary", with_scored(
    "select count(*) as total_count, count(*) filter (where prediction = 'FRAUD') as fraud_count, "
    "count(*) filter (where prediction = 'LEGIT') as legit_count, coalesce(round(avg(processing_time_ms), 1), 0.0) "
    f"as avg_processing_time_ms from ({FEED})"))
def live_feed_summary(spark, sf):
    """A29 + P12: feed counts and mean latency."""
    return A.live_feed_summary(A.live_feed(A.newest_scored(base.tx(spark, sf))))


@register("region_insights", with_scored(
    "select region, round(fpr, 6) as fpr, round(case when max(case when region = 'Domestic' then fpr end) over () > 0 "
    "then fpr / max(case when region = 'Domestic' then fpr end) over () end, 6) as fpr_ratio_to_domestic from ("
    f"select region, {FPR} as fpr from (select region, {CM} from scored group by 1))"))
def region_insights(spark, sf):
    """A34 (re-aimed): each region's FPR relative to Domestic."""
    return rounded(A.region_insights(base.scored(spark, sf)))
