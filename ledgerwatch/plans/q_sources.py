"""Registered queries: sources and sinks. Each writes under the shared
checkpoint folder (a fresh sub-folder per run) and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..operators import features as FE
from ..session import scratch_path
from ..sources import files as FS
from ..sources.tables import TRANSACTIONS_SCHEMA, read_table
from . import base
from .q_features import TX_COLS
from .q_green import RUNS, runs
from .registry import register, rounded
from .sqlbase import with_features, with_scored, with_tx


@register("csv_roundtrip", with_tx(f"select {TX_COLS} from transactions"))
def csv_roundtrip(spark, sf):
    """Write the transactions as CSV, read back with the declared schema."""
    path = scratch_path(spark, "csv")
    FS.write_csv(base.tx(spark, sf), path)
    return FS.read_csv(spark, path, TRANSACTIONS_SCHEMA)


@register("ingest_append", with_tx(
    "select batch, rows, cast(sum(rows) over (order by batch) as bigint) as cumulative_rows from (select case when "
    "transaction_timestamp < timestamp '2024-01-11 00:00:00' then 1 when transaction_timestamp < timestamp "
    "'2024-01-21 00:00:00' then 2 else 3 end as batch, count(*) as rows from transactions group by 1)"))
def ingest_append(spark, sf):
    """S6 + A1: three arriving batches appended to the raw zone; rows per
    batch read back from storage, with the running total."""
    t = base.tx(spark, sf)
    path, log = scratch_path(spark, "raw"), scratch_path(spark, "raw-log")
    ts = F.col("transaction_timestamp")
    bounds = [("1900-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "9999-01-01")]
    for i, (lo, hi) in enumerate(bounds, start=1):
        batch = t.where((ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz")))
        FS.logged_write(batch.withColumn("batch", F.lit(i)), path, "append", log)
    back = spark.read.parquet(path).groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))
    from pyspark.sql.window import Window
    # One row per batch: the running total is a window over a handful of rows.
    return back.withColumn("cumulative_rows", F.sum("rows").over(Window.orderBy("batch")))


@register("write_history", with_tx(
    "select cast(v as bigint) as version, op as operation, rows from (select 0 as v, 'WRITE' as op, count(*) as rows from "
    "transactions where cohort = 'baseline' union all select 1, 'APPEND', count(*) from transactions where cohort = 'current' "
    "union all select 2, 'WRITE', count(*) from transactions)"))
def write_history(spark, sf):
    """S7 + S10 + K7: overwrite, append, overwrite again; the write log
    (newest 5) with the row counts observed during each write."""
    t = base.tx(spark, sf)
    path, log = scratch_path(spark, "tx"), scratch_path(spark, "tx-log")
    FS.logged_write(t.where(F.col("cohort") == "baseline"), path, "overwrite", log)
    FS.logged_write(t.where(F.col("cohort") == "current"), path, "append", log)
    FS.logged_write(t, path, "overwrite", log)
    return FS.write_history(spark, log).select("version", "operation", "rows")


@register("feature_store_versions", with_features(
    "select 'v1.0' as feature_version, count(*) as rows, round(avg(rule_based_risk), 6) as mean_risk from features "
    "union all select 'v1.0-local', count(*), round(avg(least(greatest(least(greatest(amount_deviation_ratio, 0.0), 3.0)*0.1 "
    "+ is_new_merchant*0.3 + is_cross_border*0.25 + (case when tx_count_7d > 20 then 1.0 else 0.0 end)*0.2, 0.0), 1.0)), 6) "
    "from features"))
def feature_store_versions(spark, sf):
    """S8 + S9: two feature versions written into one table partitioned by
    version (schema merged); each version read back through partition
    pruning."""
    f = FE.feature_table(base.tx(spark, sf))
    local = f.withColumn("rule_based_risk", FE.rule_risk(F.col("amount_deviation_ratio"), F.col("is_new_merchant"),
                                                         F.col("is_cross_border"), F.col("tx_count_7d"), "local")) \
        .withColumn("feature_version", F.lit(P.FEATURE_VERSION_LOCAL))
    path, log = scratch_path(spark, "features"), scratch_path(spark, "features-log")
    FS.write_features(f, path, log)
    FS.write_features(local, path, log)
    out = None
    for v in (P.FEATURE_VERSION, P.FEATURE_VERSION_LOCAL):
        part = FS.read_feature_store(spark, path, v).agg(F.lit(v).alias("feature_version"),
                                                         F.count(F.lit(1)).alias("rows"),
                                                         F.avg("rule_based_risk").alias("mean_risk"))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@register("feature_schema_evolution", with_features(
    "select 'v0.9' as feature_version, transaction_id, customer_id, is_fraud, cast(tx_count_7d as bigint) as tx_count_7d, "
    "cast(null as double) as amount_deviation_ratio from features union all select 'v1.0', transaction_id, customer_id, "
    "is_fraud, cast(tx_count_7d as bigint), round(amount_deviation_ratio, 6) from features union all select 'v1.1', "
    "transaction_id, null, is_fraud, null, round(amount_deviation_ratio, 6) from features"))
def feature_schema_evolution(spark, sf):
    """Three feature versions with different columns in one table: the
    first counts in 32 bits and lacks the deviation ratio, the second widens
    the count, the third drops customer and count. All rows read back."""
    f = base.features_table(spark, sf).select("transaction_id", "customer_id", "is_fraud", "tx_count_7d", "amount_deviation_ratio")
    path, log = scratch_path(spark, "evolving"), scratch_path(spark, "evolving-log")
    version = lambda df, v: df.withColumn("feature_version", F.lit(v))
    FS.write_features(version(f.drop("amount_deviation_ratio").withColumn("tx_count_7d", F.col("tx_count_7d").cast("int")), "v0.9"), path, log)
    FS.write_features(version(f.withColumn("tx_count_7d", F.col("tx_count_7d").cast("long")), "v1.0"), path, log)
    FS.write_features(version(f.drop("customer_id", "tx_count_7d"), "v1.1"), path, log)
    return rounded(FS.read_feature_store(spark, path))


@register("latest_batch", with_tx(
    "select count(*) as rows, round(sum(transaction_amount), 6) as amount, max(cast(transaction_timestamp as date)) as batch_date "
    "from transactions where cast(transaction_timestamp as date) = (select max(cast(transaction_timestamp as date)) "
    "from transactions)"))
def latest_batch(spark, sf):
    """The newest batch by business date, from a raw zone partitioned by
    date."""
    path = scratch_path(spark, "dated")
    FS.write_dated(base.tx(spark, sf), path)
    return FS.latest_batch(spark, path).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("transaction_amount").cast("decimal(38,8)")).cast("double").alias("amount"),
        F.max("batch_date").alias("batch_date")).transform(rounded)


@register("newest_arrival", with_tx(f"select {TX_COLS} from transactions where transaction_id % 3 = 2"))
def newest_arrival(spark, sf):
    """Of three batches that arrived one after another, the last."""
    t = base.tx(spark, sf)
    path = scratch_path(spark, "arrived")
    for i in range(3):
        t.where(F.pmod("transaction_id", F.lit(3)) == i).write.parquet(f"{path}/batch-{i}")
    return FS.newest_arrival(spark, path, t.schema)


@register("report_json_roundtrip", with_scored(
    "select run_id, start_time, records, round(duration_seconds, 6) as duration_seconds, parallelism, accuracy, "
    "false_positive_rate, f1_score, round(energy_kwh, 6) as energy_kwh from runs", RUNS))
def report_json_roundtrip(spark, sf):
    """The run reports written as JSON and read back with their schema."""
    r = runs(spark, sf)
    path = scratch_path(spark, "reports")
    r.write.mode("overwrite").json(path)
    return rounded(FS.read_json(spark, path, r.schema))


@register("catalog_table_scan", with_tx(f"select {TX_COLS} from transactions"))
def catalog_table_scan(spark, sf):
    """S4 + S5: the transactions saved as a table, read by its name and by
    ``SELECT *``."""
    FS.save_as_table(base.tx(spark, sf), "ledgerwatch_transactions", scratch_path(spark, "table"))
    return spark.sql("SELECT * FROM ledgerwatch_transactions")


@register("synthetic_transactions", (
    "select event_id as row_id, 'C' || lpad(cast(event_id % 500 as varchar), 5, '0') as customer_id, "
    "'TX-' || lpad(cast(event_id as varchar), cast(greatest(7, len(cast(event_id as varchar))) as integer), '0') as transaction_id, "
    "timestamp '2024-01-01 00:00:00' + to_minutes(cast(event_id * 5 as integer)) as transaction_timestamp from events"))
def synthetic_transactions(spark, sf):
    """Synthetic transactions driven by the event ids (arithmetic
    columns compared; hashed columns checked by tests)."""
    ids = read_table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return FS.synthetic_transactions(ids).select("row_id", "customer_id", "transaction_id", "transaction_timestamp")
