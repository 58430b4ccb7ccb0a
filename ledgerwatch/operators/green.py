"""Green-compute metrics over a run log: energy per run, daily series,
totals, carbon budget; plus the run register (newest runs, latest run
overlaid on defaults)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import params as P
from ..sources import versions as V
from .evaluation import classification_metrics


def energy_kwh(seconds, parallelism):
    """kWh = seconds / 3600 · 0.095 kW per core · parallelism."""
    return seconds / 3600.0 * P.KW_PER_CORE * parallelism


def run_log_from_scored(scored: DataFrame, ts: str = "transaction_timestamp", parallelism: int = 4) -> DataFrame:
    """The ``run_log`` fixture: one scoring run per event day, with that
    day's metrics; every 7th day of the month has no energy reading."""
    m = classification_metrics(scored.withColumn("_day", F.to_date(ts)), by=["_day"])
    # Exact (decimal) sum so the energy formula sees the same number whatever
    # the order partial sums arrive in.
    amt = scored.groupBy(F.to_date(ts).alias("_day")).agg(
        F.sum(F.col("transaction_amount").cast("decimal(38,8)")).cast("double").alias("duration_seconds"))
    j = m.join(amt, "_day")
    kwh = energy_kwh(F.col("duration_seconds"), F.lit(parallelism))
    return j.select(
        F.concat(F.lit("run-"), F.date_format("_day", "yyyyMMdd")).alias("run_id"),
        F.col("_day").cast("timestamp_ntz").alias("start_time"),
        F.col("n").alias("records"), "duration_seconds", F.lit(parallelism).alias("parallelism"),
        "accuracy", "false_positive_rate", "f1_score",
        F.when(F.dayofmonth("_day") % 7 == 0, F.lit(None).cast("double")).otherwise(kwh).alias("energy_kwh"))


RUN_SCHEMA = ("run_id string, start_time timestamp_ntz, records long, duration_seconds double, parallelism int, "
              "accuracy double, false_positive_rate double, f1_score double, energy_kwh double")


def training_run(metrics: DataFrame, run_id: str, start_time, seconds: float, parallelism: int) -> DataFrame:
    """The register's row of one training run, from its metrics row
    (n, accuracy, false_positive_rate, f1_score) and its measured time."""
    return metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(start_time).cast("timestamp_ntz").alias("start_time"), F.col("n").cast("long").alias("records"),
        F.lit(float(seconds)).alias("duration_seconds"), F.lit(parallelism).cast("int").alias("parallelism"),
        "accuracy", "false_positive_rate", "f1_score", F.lit(float(energy_kwh(seconds, parallelism))).alias("energy_kwh"))


def append_run(run: DataFrame, register: str) -> None:
    """Append to the run register; each run is a file of its own, so
    writers don't meet."""
    run.coalesce(1).write.mode("append").parquet(register)


def read_runs(spark: SparkSession, register: str) -> DataFrame:
    """The run register; empty before the first run."""
    if not V.exists(spark, register):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(register)


def green_run_metrics(runs: DataFrame) -> DataFrame:
    """A30 per run: energy, CO2 grams, records per kWh (kWh floored at 0.001)."""
    kwh = energy_kwh(F.col("duration_seconds"), F.col("parallelism"))
    return runs.select("run_id", "records", kwh.alias("estimated_energy_kwh"),
                       (kwh * P.CO2_GRAMS_PER_KWH).alias("estimated_co2_grams"),
                       (F.col("records") / F.greatest(kwh, F.lit(P.MIN_KWH_FLOOR))).alias("efficiency_records_per_kwh"))


def green_daily(runs: DataFrame) -> DataFrame:
    """A31 + A33: daily energy and CO2 (missing energy → 0) and whether the
    day is above the average day. One row per day → a bounded window."""
    d = runs.groupBy(F.to_date("start_time").alias("day")).agg(
        F.sum(F.coalesce(F.col("energy_kwh"), F.lit(0.0))).alias("kwh"))
    avg = F.avg("kwh").over(Window.partitionBy(F.lit(1)))
    return d.select("day", F.date_format("day", "E").alias("weekday"), "kwh",
                    (F.col("kwh") * P.CO2_GRAMS_PER_KWH).alias("co2_grams"), (F.col("kwh") > avg).alias("above_average"))


def green_totals(runs: DataFrame) -> DataFrame:
    """A31 totals: energy, CO2, run count, records per kWh."""
    kwh = F.sum(F.coalesce(F.col("energy_kwh"), F.lit(0.0)))
    return runs.agg(kwh.alias("total_energy_kwh"), (kwh * P.CO2_GRAMS_PER_KWH).alias("total_co2_grams"),
                    F.count(F.lit(1)).alias("training_runs"),
                    (F.sum("records") / F.greatest(kwh, F.lit(P.MIN_KWH_FLOOR))).alias("efficiency_records_per_kwh"))


def carbon_budget(totals: DataFrame, limit_kwh: float = P.GREEN_COMPUTE_LIMIT_KWH) -> DataFrame:
    """Share of the energy budget used and its display status."""
    pct = F.col("total_energy_kwh") / F.lit(limit_kwh) * 100
    return totals.select("total_energy_kwh", F.lit(limit_kwh).alias("limit_kwh"), pct.alias("budget_used_pct"),
                         F.when(pct > P.CARBON_RED_PCT, "red").when(pct > P.CARBON_AMBER_PCT, "amber")
                         .otherwise("green").alias("status"))


def run_history(runs: DataFrame, prefix: str = "run-", n: int = 5) -> DataFrame:
    """K3 + P13: the newest ``n`` runs whose id starts with ``prefix``."""
    return runs.where(F.col("run_id").startswith(prefix)).orderBy(F.col("start_time").desc(), F.col("run_id")) \
        .limit(n).select("run_id", "start_time", "accuracy", "false_positive_rate", "f1_score", "energy_kwh")


def model_health(runs: DataFrame) -> DataFrame:
    """M11 + F17: the latest run's metrics laid over the defaults."""
    latest = runs.agg(F.max(F.struct(F.col("start_time"), F.col("run_id"), F.col("accuracy"),
                                     F.col("false_positive_rate"), F.col("f1_score"))).alias("_l"))
    return latest.select(
        F.coalesce(F.col("_l.accuracy"), F.lit(P.HEALTH_DEFAULT_ACCURACY)).alias("accuracy"),
        F.coalesce(F.col("_l.false_positive_rate"), F.lit(P.HEALTH_DEFAULT_FPR)).alias("false_positive_rate"),
        F.coalesce(F.col("_l.f1_score"), F.lit(P.HEALTH_DEFAULT_F1)).alias("f1_score"),
        F.col("_l.run_id").alias("run_id"), F.lit("local").alias("mode"))
