"""Registered queries: scans, feature table, windows, rule scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_to

from .. import params as P
from ..operators import features as FE
from . import base
from .registry import r6, register, rounded
from .sqlbase import SCORED, with_features, with_scored, with_tx

TX_COLS = ("transaction_id, customer_id, transaction_timestamp, transaction_amount, merchant_category, merchant_id, "
           "merchant_country, customer_country, customer_age_days, device_fingerprint, is_fraud, processing_time_ms, "
           "customer_segment, region, age_band, cohort")


@register("scan_transactions", with_tx(f"select {TX_COLS} from transactions"))
def scan_transactions(spark, sf):
    """The transactions view over the raw tables."""
    return base.tx(spark, sf)


FEATURE_OUT = [c for c in P.FEATURE_COLUMNS if c != "feature_timestamp"]


@register("feature_table", with_features(
    "select customer_id, transaction_id, transaction_timestamp, transaction_amount, merchant_category, "
    "merchant_country, customer_country, device_fingerprint, tx_count_7d, round(avg_amount_30d, 6) as avg_amount_30d, "
    "round(amount_deviation_ratio, 6) as amount_deviation_ratio, hour_of_day, is_weekend, is_new_merchant, "
    "is_cross_border, round(rule_based_risk, 6) as rule_based_risk, is_fraud, 'v1.0' as feature_version from features"))
def feature_table(spark, sf):
    """The feature-store table (run-time timestamp left out)."""
    return rounded(FE.feature_table(base.tx(spark, sf)).select(*FEATURE_OUT))


@register("tx_velocity_7d", with_features(
    "select transaction_id, customer_id, tx_count_7d from features"))
def tx_velocity_7d(spark, sf):
    """7-day trailing count per customer, ties included."""
    return FE.trailing_features(base.tx(spark, sf)).select("transaction_id", "customer_id", "tx_count_7d")


@register("avg_amount_30d", with_features(
    "select transaction_id, round(avg_amount_30d, 6) as avg_amount_30d from features"))
def avg_amount_30d(spark, sf):
    """W2 on transactions."""
    return FE.trailing_features(base.tx(spark, sf)).select("transaction_id", r6("avg_amount_30d").alias("avg_amount_30d"))


ORDERS_TRAILING = f"""WITH {base.ORDERS_SQL}
select transaction_id,
  count(transaction_id) over (partition by customer_id order by transaction_timestamp
      range between interval 7 days preceding and current row) as tx_count_7d,
  round(avg(cast(transaction_amount as decimal(38,8))) over (partition by customer_id order by transaction_timestamp
      range between interval 30 days preceding and current row), 6) as avg_amount_30d,
  cast(count(merchant_id) over (partition by customer_id order by transaction_timestamp
      range between interval 30 days preceding and current row) = 1 as integer) as is_new_merchant
from orders_tx"""


@register("orders_trailing_windows", ORDERS_TRAILING)
def orders_trailing_windows(spark, sf):
    """W1–W3 on the multi-year orders history, where 30-day frames drop rows."""
    f = FE.trailing_features(base.orders_tx(spark, sf))
    return f.select("transaction_id", "tx_count_7d", r6("avg_amount_30d").alias("avg_amount_30d"),
                    (F.col("merchant_count_30d") == 1).cast("int").alias("is_new_merchant"))


@register("is_new_merchant", with_features(
    "select transaction_id, merchant_count_30d, is_new_merchant from features"))
def is_new_merchant(spark, sf):
    """W3 as coded: only one non-null merchant in the customer's last 30 days."""
    f = FE.derived_features(FE.trailing_features(base.tx(spark, sf)))
    return f.select("transaction_id", "merchant_count_30d", "is_new_merchant")


@register("prior_mean_amount", f"""WITH {base.ORDERS_SQL}
select transaction_id, round(coalesce(
    avg(transaction_amount) over (partition by customer_id order by transaction_timestamp, transaction_id
        rows between unbounded preceding and 1 preceding),
    avg(transaction_amount) over (partition by customer_id)), 6) as avg_amount_prior
from orders_tx""")
def prior_mean_amount(spark, sf):
    """W4 on orders (tied dates): mean of all earlier rows, first row → whole mean."""
    out = FE.prior_mean_amount(base.orders_tx(spark, sf))
    return out.select("transaction_id", r6("avg_amount_prior").alias("avg_amount_prior"))


@register("first_activity", f"""WITH {base.ORDERS_SQL}
select transaction_id, cast(count(merchant_id) over (partition by customer_id
    order by transaction_timestamp, transaction_id rows between unbounded preceding and current row) = 1 as integer)
    as is_first_activity
from orders_tx""")
def first_activity(spark, sf):
    """W5 on orders: running non-null merchant count equals one."""
    return FE.first_activity(base.orders_tx(spark, sf)).select("transaction_id", "is_first_activity")


@register("first_at_merchant", with_tx(
    "select transaction_id, customer_id, merchant_id, cast(row_number() over (partition by customer_id, merchant_id "
    "order by transaction_timestamp, transaction_id) = 1 as integer) as is_first_at_merchant from transactions"))
def first_at_merchant(spark, sf):
    """First transaction of the customer at this merchant."""
    return FE.first_at_merchant(base.tx(spark, sf)).select("transaction_id", "customer_id", "merchant_id",
                                                           "is_first_at_merchant")


@register("rule_based_risk", with_features(
    "select transaction_id, round(rule_based_risk, 6) as risk_notebook, "
    "round(least(greatest(least(greatest(amount_deviation_ratio, 0.0), 3.0)*0.1 + is_new_merchant*0.3 "
    "+ is_cross_border*0.25 + (case when tx_count_7d > 20 then 1.0 else 0.0 end)*0.2, 0.0), 1.0), 6) as risk_local "
    "from features"))
def rule_based_risk(spark, sf):
    """Notebook (unclipped) and local (clipped) rule scores."""
    f = FE.engineer_features(base.tx(spark, sf))
    local = FE.rule_risk(F.col("amount_deviation_ratio"), F.col("is_new_merchant"), F.col("is_cross_border"),
                         F.col("tx_count_7d"), variant="local")
    return f.select("transaction_id", r6("rule_based_risk").alias("risk_notebook"), r6(local).alias("risk_local"))


TIER_SQL = "case when score > 0.7 then 'HIGH' when score > 0.3 then 'MEDIUM' else 'LOW' end"


def risk_tier_col(c):
    return F.when(c > P.TIER_HIGH, "HIGH").when(c > P.TIER_MEDIUM, "MEDIUM").otherwise("LOW")


@register("risk_tier", with_scored(f"select {TIER_SQL} as risk_level, count(*) as n, round(avg(score), 6) as mean_score "
                                   "from scored group by 1"))
def risk_tier(spark, sf):
    """HIGH / MEDIUM / LOW tiers of the score."""
    s = base.scored(spark, sf).withColumn("risk_level", risk_tier_col(F.col("score")))
    return s.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("score")).alias("mean_score"))


@register("rule_scoring", with_scored(
    f"select transaction_id, prediction, round(score, 4) as fraud_probability, {TIER_SQL} as risk_level, "
    "'rule-v1.0' as model_version from scored"))
def rule_scoring(spark, sf):
    """M6 with the rule model: prediction, probability to 4 places, tier, version."""
    s = base.scored(spark, sf)
    return s.select("transaction_id", "prediction", round_to(F.col("score"), 4).alias("fraud_probability"),
                    risk_tier_col(F.col("score")).alias("risk_level"), F.lit("rule-v1.0").alias("model_version"))


_ = SCORED  # noqa: the scored CTE is used through with_scored
