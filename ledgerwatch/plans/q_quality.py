"""Registered queries: data-quality checks and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..operators import features as FE
from ..operators import quality as Q
from ..session import scratch_path
from . import base
from .registry import r6, register, rounded
from .sqlbase import with_features, with_features_and, with_tx

TX_COLUMNS = ["transaction_id", "customer_id", "transaction_timestamp", "transaction_amount", "merchant_category",
              "merchant_id", "merchant_country", "customer_country", "customer_age_days", "device_fingerprint",
              "is_fraud", "processing_time_ms", "customer_segment", "region", "age_band", "cohort"]

# The feature table as SQL (the run-time timestamp is a non-null constant).
FEATURE_TABLE_SQL = ("select " + ", ".join(c for c in P.FEATURE_COLUMNS if c not in ("feature_version", "feature_timestamp"))
                     + ", 'v1.0' as feature_version, current_timestamp as feature_timestamp from features")


def _completeness_sql(cols: list[str], table: str) -> str:
    terms = " + ".join(f"count({c})/count(*)" for c in cols)
    return f"select round(({terms})/{float(len(cols))}, 6) as completeness from {table}"


@register("fraud_counts", with_tx("select is_fraud, count(*) as n from transactions group by is_fraud"))
def fraud_counts(spark, sf):
    """A2: rows per label."""
    return Q.label_counts(base.tx(spark, sf))


@register("amount_baseline", with_tx(
    "select cohort, count(transaction_amount) as n, round(avg(transaction_amount), 6) as mean_amount, "
    "round(stddev_samp(transaction_amount), 6) as std_amount from transactions group by cohort"))
def amount_baseline(spark, sf):
    """A3: mean and sample standard deviation of the amount per cohort."""
    return rounded(Q.amount_stats(base.tx(spark, sf), "cohort"))


@register("feature_store_summary", with_features(
    "select count(*) as total_records, max(transaction_timestamp) as latest_transaction_timestamp, "
    "count(distinct customer_id) as customers from features"))
def feature_store_summary(spark, sf):
    """A1/A4: records in the feature table, newest event time, customers."""
    f = FE.feature_table(base.tx(spark, sf))
    return f.agg(F.count(F.lit(1)).alias("total_records"),
                 F.max("transaction_timestamp").alias("latest_transaction_timestamp"),
                 F.countDistinct("customer_id").alias("customers"))


@register("completeness", with_tx(_completeness_sql(TX_COLUMNS, "transactions")))
def completeness(spark, sf):
    """A5: mean non-null share over all columns."""
    return Q.completeness(base.tx(spark, sf)).select(r6("completeness").alias("completeness"))


@register("column_completeness", with_tx(" union all ".join(
    f"select '{c}' as column_name, {i + 1} as position, round(count({c})/count(*), 6) as non_null_share from transactions"
    for i, c in enumerate(TX_COLUMNS))))
def column_completeness(spark, sf):
    """Non-null share per column, one pass, long form."""
    out = Q.column_completeness(base.tx(spark, sf))
    return out.select("column_name", "position", r6("non_null_share").alias("non_null_share"))


@register("class_imbalance", with_tx(
    "select count(*) filter (where is_fraud = 0) as n_legit, count(*) filter (where is_fraud = 1) as n_fraud, "
    "round(case when count(*) filter (where is_fraud = 0) = 0 then 1 else count(*) filter (where is_fraud = 0) end "
    "/ greatest(case when count(*) filter (where is_fraud = 1) = 0 then 1 else count(*) filter (where is_fraud = 1) end, 1), 6) "
    "as imbalance_ratio from transactions"))
def class_imbalance(spark, sf):
    """Legit / max(fraud, 1), counts defaulting to 1 when a class is absent."""
    return rounded(Q.class_imbalance(base.tx(spark, sf)))


@register("violating_rows", with_features(
    "select * from (select transaction_id, cast(coalesce(transaction_amount <= 0, false) as integer) as amount_not_positive, "
    "cast(coalesce(transaction_amount > 1000000.0, false) as integer) as amount_over_max, "
    "cast(coalesce(rule_based_risk < 0.0 or rule_based_risk > 1.0, false) as integer) as risk_out_of_range, "
    "cast(coalesce(customer_id is null or transaction_amount is null or is_fraud is null, false) as integer) as has_required_null "
    "from features) where amount_not_positive + amount_over_max + risk_out_of_range + has_required_null > 0"))
def violating_rows(spark, sf):
    """Rows failing a row rule (the notebook risk is unclipped, so X2 shows here)."""
    return Q.violating_rows(FE.engineer_features(base.tx(spark, sf)))


def _suite_sql() -> str:
    parts, i = [], 0
    for c in P.SUITE_EXISTENCE_COLUMNS:
        i += 1
        parts.append(f"select {i} as check_id, 'expect_column_to_exist' as expectation, '{c}' as column_name, "
                     "true as success, cast(0 as bigint) as unexpected_count, cast(null as double) as observed_value")
    for c, cond in [("transaction_amount", "transaction_amount < 0.01 or transaction_amount > 1000000.0"),
                    ("rule_based_risk", "rule_based_risk < 0.0 or rule_based_risk > 1.0")]:
        i += 1
        parts.append(f"select {i}, 'expect_column_values_to_be_between', '{c}', count(*) filter (where {cond}) = 0, "
                     f"count(*) filter (where {cond}), cast(null as double) from features")
    i += 1
    parts.append(f"select {i}, 'expect_column_mean_to_be_between', 'is_fraud', avg(is_fraud) >= 0.005 and avg(is_fraud) <= 0.05, "
                 "cast(null as bigint), round(avg(is_fraud), 6) from features")
    for c in P.NOT_NULL_COLUMNS:
        i += 1
        parts.append(f"select {i}, 'expect_column_values_to_not_be_null', '{c}', count(*) filter (where {c} is null) = 0, "
                     f"count(*) filter (where {c} is null), cast(null as double) from features")
    return with_features(" union all ".join(parts))


@register("expectation_suite", _suite_sql())
def expectation_suite(spark, sf):
    """V2 + U2: the expectation list from a single aggregation pass."""
    return rounded(Q.expectation_suite(FE.engineer_features(base.tx(spark, sf))))


@register("local_validation", with_features(
    "select len(f) = 0 as passed, array_to_string(f, '; ') as failures from (select list_filter([ "
    "case when count(*) filter (where transaction_amount <= 0) > 0 then 'transaction_amount must be positive' end, "
    "case when max(transaction_amount) > 1000000.0 then 'transaction_amount exceeds max' end, "
    "case when min(rule_based_risk) < 0 or max(rule_based_risk) > 1 then 'rule_based_risk out of [0,1]' end, "
    "case when avg(is_fraud) < 0.005 or avg(is_fraud) > 0.05 then printf('is_fraud rate %.3f outside [0.5%%, 5%%]', avg(is_fraud)) end, "
    "case when count(*) filter (where customer_id is null) > 0 then 'Nulls in customer_id' end, "
    "case when count(*) filter (where transaction_amount is null) > 0 then 'Nulls in transaction_amount' end, "
    "case when count(*) filter (where is_fraud is null) > 0 then 'Nulls in is_fraud' end], lambda x: x is not null) as f "
    "from features)"))
def local_validation(spark, sf):
    """V3: local suite, failure messages in check order."""
    out = Q.local_validation(FE.engineer_features(base.tx(spark, sf)))
    return out.select("passed", F.array_join("failures", "; ").alias("failures"))


@register("mean_shift", with_tx(
    "select round(b.m, 6) as baseline_mean, round(b.s, 6) as baseline_std, round(c.m, 6) as current_mean, "
    "round(abs(c.m - b.m) / b.m, 6) as shift, abs(c.m - b.m) / b.m > 0.15 as warning from "
    "(select avg(transaction_amount) as m, stddev_samp(transaction_amount) as s from transactions where cohort = 'baseline') b, "
    "(select avg(transaction_amount) as m from transactions where cohort = 'current') c"))
def mean_shift(spark, sf):
    """V4 + J5: current mean amount against the stored baseline."""
    return rounded(Q.mean_shift(base.tx(spark, sf)))


@register("stored_mean_shift", with_tx(
    "select 1 as run, true as created, round(b.m, 6) as baseline_mean, round(b.s, 6) as baseline_std, round(b.m, 6) as current_mean, "
    "cast(null as double) as shift, false as warning from b union all "
    "select 2, false, round(b.m, 6), round(b.s, 6), round(c.m, 6), round(abs(c.m - b.m) / b.m, 6), abs(c.m - b.m) / b.m > 0.15 from b cross join c").replace(
    "select 1 as run", ", b AS (select avg(transaction_amount) as m, stddev_samp(transaction_amount) as s from transactions where cohort = 'baseline'), "
    "c AS (select avg(transaction_amount) as m from transactions where cohort = 'current') select 1 as run", 1))
def stored_mean_shift(spark, sf):
    """V4 + J5: two runs against one store: the first saves the baseline
    cohort's statistics, the second compares the current cohort with them."""
    t = base.tx(spark, sf)
    store = scratch_path(spark, "amount-baseline")
    first = Q.mean_shift_against_stored(t.where(F.col("cohort") == "baseline"), store)
    second = Q.mean_shift_against_stored(t.where(F.col("cohort") == "current"), store)
    return rounded(first.select(F.lit(1).alias("run"), "*").unionByName(second.select(F.lit(2).alias("run"), "*")))


def _required_sql() -> str:
    policies = [("feature_schema", P.FEATURE_COLUMNS), ("governance", P.GOVERNANCE_REQUIRED_FEATURES),
                ("local", P.LOCAL_REQUIRED_COLUMNS)]
    parts = []
    for pol, cols in policies:
        for i, c in enumerate(cols):
            present = c in P.FEATURE_COLUMNS
            src = f"count({c}) as non_null_count from ft" if present else "cast(0 as bigint) as non_null_count"
            parts.append(f"select '{pol}' as policy, {i + 1} as position, '{c}' as column_name, {str(present).lower()} as present, "
                         f"{src}")
    return with_features_and(f"ft AS ({FEATURE_TABLE_SQL})", " union all ".join(parts))


@register("required_columns", _required_sql())
def required_columns(spark, sf):
    """V1: every policy's required columns, present or not, with non-null counts."""
    return Q.required_columns(FE.feature_table(base.tx(spark, sf)))


def _missing_sql() -> str:
    missing = [m for m in P.GOVERNANCE_REQUIRED_FEATURES if m not in P.FEATURE_COLUMNS]
    if not missing:
        return ""
    msg = f"Missing required features: {missing!r}".replace("'", "''")
    return f"'{msg}', "


@register("data_quality_gate", with_features_and(f"ft AS ({FEATURE_TABLE_SQL})", (
    "select 'data_quality' as policy, len(v) = 0 as passed, round(c, 6) as completeness, array_to_string(v, '; ') as violations, n as records_checked "
    "from (select c, n, list_filter([case when c < 0.95 then printf('Data completeness %.2f%% below threshold 95.00%%', c*100) end, "
    + _missing_sql() +
    "case when r > 10.0 then printf('Class imbalance ratio %.1fx exceeds policy 10x', r) end], lambda x: x is not null) as v "
    "from (select (" + " + ".join(f"count({c})/count(*)" for c in P.FEATURE_COLUMNS) + f")/{float(len(P.FEATURE_COLUMNS))} as c, "
    "count(*) as n, (case when count(*) filter (where is_fraud = 0) = 0 then 1 else count(*) filter (where is_fraud = 0) end) "
    "/ greatest(case when count(*) filter (where is_fraud = 1) = 0 then 1 else count(*) filter (where is_fraud = 1) end, 1) as r "
    "from ft))")))
def data_quality_gate(spark, sf):
    """G1: completeness ≥ .95, governance features present, imbalance ≤ 10 → audit row."""
    g = Q.data_quality_gate(FE.feature_table(base.tx(spark, sf)))
    return g.withColumn("completeness", r6("completeness")).withColumn("violations", F.array_join("violations", "; "))
