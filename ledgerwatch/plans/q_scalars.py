"""Registered queries: scalar functions over every transaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.numeric import round_to
from . import base
from .registry import register, rounded
from .sqlbase import with_tx


@register("scalar_ids", with_tx(
    "select transaction_id, 'C' || lpad(cast(customer_id as varchar), cast(greatest(5, len(cast(customer_id as varchar))) as integer), '0') as customer_code, "
    "'TX-' || lpad(cast(transaction_id as varchar), cast(greatest(7, len(cast(transaction_id as varchar))) as integer), '0') as transaction_code, "
    "'M' || lpad(cast(merchant_id as varchar), cast(greatest(4, len(cast(merchant_id as varchar))) as integer), '0') as merchant_code from transactions"))
def scalar_ids(spark, sf):
    """zero-padded identifiers."""
    t = base.tx(spark, sf)
    return t.select("transaction_id", S.padded_id("C", F.col("customer_id"), 5).alias("customer_code"),
                    S.padded_id("TX-", F.col("transaction_id"), 7).alias("transaction_code"),
                    S.padded_id("M", F.col("merchant_id"), 4).alias("merchant_code"))


@register("scalar_time_format", with_tx(
    "select transaction_id, strftime(transaction_timestamp, '%b') as month_abbr, "
    "strftime(transaction_timestamp, '%H:00') as hour_label, strftime(transaction_timestamp, '%H:%M:%S') as clock, "
    "strftime(transaction_timestamp, '%Y-%m-%dT%H:%M:%S') as iso, strftime(transaction_timestamp, '%Y%m%d_%H%M%S') "
    "as file_stamp, cast(hour(transaction_timestamp) as integer) as hour_of_day, "
    "cast(dayofweek(transaction_timestamp) + 1 as integer) as day_of_week from transactions"))
def scalar_time_format(spark, sf):
    """F3 + F4: hour, day of week (Sunday = 1) and the display formats."""
    t = base.tx(spark, sf)
    ts = F.col("transaction_timestamp")
    return t.select("transaction_id", *S.time_formats(ts), F.hour(ts).alias("hour_of_day"),
                    F.dayofweek(ts).alias("day_of_week"))


@register("scalar_time_shift", with_tx(
    "select transaction_id, transaction_timestamp - interval 30 days as minus_30_days, "
    "transaction_timestamp - interval 1 hour as minus_1_hour, transaction_timestamp - interval 90 seconds "
    "as minus_90_seconds from transactions"))
def scalar_time_shift(spark, sf):
    """subtract days, hours and seconds."""
    t = base.tx(spark, sf)
    ts = F.col("transaction_timestamp")
    return t.select("transaction_id", S.shift(ts, days=30).alias("minus_30_days"),
                    S.shift(ts, hours=1).alias("minus_1_hour"), S.shift(ts, seconds=90).alias("minus_90_seconds"))


@register("scalar_math", with_tx(
    "select transaction_id, round(abs(transaction_amount - 50.0), 6) as abs_dev, round(ln(transaction_amount + 1.0), 6) "
    "as log_amount, round(transaction_amount, 0) as rounded_amount, cast(trunc(transaction_amount) as bigint) as int_amount "
    "from transactions"))
def scalar_math(spark, sf):
    """abs, ln, round (half away from zero) and integer truncation."""
    t = base.tx(spark, sf)
    a = F.col("transaction_amount")
    return t.select("transaction_id", round_to(F.abs(a - 50.0), 6).alias("abs_dev"),
                    round_to(F.ln(a + 1.0), 6).alias("log_amount"), round_to(a, 0).alias("rounded_amount"),
                    a.cast("bigint").alias("int_amount"))


@register("scalar_clip", with_tx(
    "select transaction_id, case when transaction_amount is null then null "
    "else least(greatest(transaction_amount, 10.0), 100.0) end as clipped_amount from transactions"))
def scalar_clip(spark, sf):
    """clip the amount to [10, 100]."""
    t = base.tx(spark, sf)
    return t.select("transaction_id", S.clip(F.col("transaction_amount"), 10.0, 100.0).alias("clipped_amount"))


@register("map_value_extremes", with_tx(
    "select customer_id, round(max(v), 6) as max_category_amount, round(min(v), 6) as min_category_amount, "
    "count(*) as categories from (select customer_id, merchant_category, "
    "cast(sum(cast(transaction_amount as decimal(38,2))) as double) as v from transactions group by 1, 2) group by 1"))
def map_value_extremes(spark, sf):
    """per customer a map category → amount, then its largest and
    smallest value. The map is built from (customer, category) aggregates,
    so each holds at most one entry per category."""
    t = base.tx(spark, sf)
    per = t.groupBy("customer_id", "merchant_category").agg(
        F.sum(F.col("transaction_amount").cast("decimal(38,2)")).cast("double").alias("v"))
    m = per.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("merchant_category", "v"))).alias("m"))
    return rounded(m.select("customer_id", S.map_max(F.col("m")).alias("max_category_amount"),
                            S.map_min(F.col("m")).alias("min_category_amount"),
                            F.size(F.map_keys("m")).cast("bigint").alias("categories")))


@register("json_scalars", (
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, "
    "'{\"k\":' || json_extract_string(props, '$.k') || ',\"type\":\"' || event_type || '\"}' as rebuilt "
    "from events"))
def json_scalars(spark, sf):
    """parse a JSON field and serialise a record back to JSON."""
    from ..sources.tables import read_table

    e = read_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", k.cast("bigint").alias("k"),
                    F.to_json(F.struct(k.cast("bigint").alias("k"), F.col("event_type").alias("type"))).alias("rebuilt"))


@register("scalar_substring", with_tx(
    "select transaction_id, r as report_id, case when starts_with(r, 'drift_') then substr(r, 7) else r end as report_date_text, "
    "substr(d, 1, 8) as short_device from (select transaction_id, 'drift_' || strftime(transaction_timestamp, '%Y%m%d') as r, "
    "device_fingerprint as d from transactions)"))
def scalar_substring(spark, sf):
    """prefix removal and an 8-character slice."""
    t = base.tx(spark, sf)
    r = F.concat(F.lit("drift_"), F.date_format("transaction_timestamp", "yyyyMMdd"))
    return t.select("transaction_id", r.alias("report_id"), S.strip_prefix(r, "drift_").alias("report_date_text"),
                    S.short_id(F.col("device_fingerprint")).alias("short_device"))
