"""Table sources: explicit schemas for the driver tables and the derived
``transactions`` view every operator of this library reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
NTZ = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One declared schema per table: reads never infer, and a file that drifts
# from it fails at scan time instead of silently changing types.
SCHEMAS: dict[str, T.StructType] = {
    "events": _schema(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                        ("c_mktsegment", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", NTZ), ("o_orderpriority", S)),
}

# Transactions view schema (column, type) in its fixed order.
TRANSACTIONS_SCHEMA = _schema(
    ("transaction_id", L), ("customer_id", L), ("transaction_timestamp", NTZ),
    ("transaction_amount", D), ("merchant_category", S), ("merchant_id", L),
    ("merchant_country", S), ("customer_country", S), ("customer_age_days", L),
    ("device_fingerprint", S), ("is_fraud", I), ("processing_time_ms", L),
    ("customer_segment", S), ("region", S), ("age_band", S), ("cohort", S),
)

COHORT_SPLIT = "2024-01-16 00:00:00"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table with its declared schema."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def ts_literal(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def transactions(spark: SparkSession, sf_dir: str, cohort_split: str = COHORT_SPLIT) -> DataFrame:
    """Card transactions derived from events, customers and nations.

    The event stream is the fact side; customers and nations are joined on
    their keys, broadcast where the optimizer or AQE sees them small. The
    nation dimension joins twice: once for the customer's home country and
    once for the merchant's country.
    """
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation")
    cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"),
                       F.col("n_regionkey").alias("cn_region"))
    mn = nation.select(F.col("n_nationkey").alias("mn_key"), F.col("n_name").alias("mn_name"),
                       F.col("n_regionkey").alias("mn_region"))

    merchant_nation = F.when(F.col("k") % 10 < 6, F.col("c_nationkey").cast("bigint")).otherwise(
        F.col("k") % 25)
    j = (
        ev.join(cust, ev.user_id == cust.c_custkey, "left")
        .join(cn, F.col("c_nationkey") == F.col("cn_key"), "left")
        .withColumn("_mkey", merchant_nation)
        .join(mn, F.col("_mkey") == F.col("mn_key"), "left")
    )
    age = (F.lit(30) + (F.col("user_id") * 251) % 3620).cast("bigint")
    device = F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("DEV-"), (F.lit(1000) + (F.col("event_id") * 13) % 8999).cast("string")))
    segment = (
        F.when(age < 365, "New Customer")
        .when(F.col("c_acctbal") >= 6000, "High Value")
        .when(F.col("c_acctbal") >= 2000, "Mid Value")
        .otherwise("Low Value")
    )
    region = (
        F.when(F.col("mn_region") != F.col("cn_region"), "International")
        .when(F.col("mn_key") != F.col("cn_key"), "Cross-Border")
        .otherwise("Domestic")
    )
    band = F.when(age < 1095, "young").when(age < 2190, "middle").otherwise("senior")
    return j.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("transaction_timestamp"),
        F.col("value").alias("transaction_amount"),
        F.col("event_type").alias("merchant_category"),
        ((F.col("k") * 7) % 97).alias("merchant_id"),
        F.col("mn_name").alias("merchant_country"),
        F.col("cn_name").alias("customer_country"),
        age.alias("customer_age_days"),
        device.alias("device_fingerprint"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 100), 1).otherwise(0)
        .cast("int").alias("is_fraud"),
        (F.lit(12) + (F.col("event_id") * 31) % 74).cast("bigint").alias("processing_time_ms"),
        segment.alias("customer_segment"),
        region.alias("region"),
        band.alias("age_band"),
        F.when(F.col("ts") < ts_literal(cohort_split), "baseline").otherwise("current")
        .alias("cohort"),
    )


def orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a multi-year transaction history: 30-day frames drop
    rows here and order dates tie inside a customer."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_timestamp"),
        F.col("o_totalprice").alias("transaction_amount"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("merchant_id"),
    )
