"""Structured Streaming forms of the naturally incremental jobs: ingest,
hourly volume with a watermark, scoring of arriving rows, and a drift
report per micro-batch. Every query checkpoints to the shared folder, so a
restarted (or failed-over) driver resumes exactly where it stopped, and
``availableNow`` processes what has arrived and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..operators import drift as D
from ..functions.numeric import round_to
from ..operators import features as FE
from ..session import materialize, scratch_path
from ..sources import versions as V


def time_slices(df: DataFrame, ts: str, n_batches: int) -> F.Column:
    """The number of a row's slice when the time span of ``df`` is cut into
    ``n_batches`` equal ranges; null times belong to the first."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi = df.agg(F.min(at), F.max(at)).first()
    if lo is None:
        return F.lit(0)
    slice_no = F.floor((at - F.lit(lo)) / F.lit((hi - lo) / n_batches or 1.0))
    return F.least(F.coalesce(slice_no, F.lit(0)), F.lit(n_batches - 1))


def land(df: DataFrame, path: str, by: str | F.Column, n_batches: int):
    """Land ``df`` in ``path`` as ``n_batches`` arrivals (the column ``by``
    modulo ``n_batches``, or the number an expression gives; null in the
    first), each written by as many tasks as it needs. Yields after every
    arrival, so that a stream run there sees each arrival as one micro-batch."""
    staged = scratch_path(df.sparkSession, "arrivals")
    number = F.pmod(F.col(by), F.lit(n_batches)) if isinstance(by, str) else by
    batch = F.coalesce(number, F.lit(0)).cast("int")
    df.withColumn("_batch", batch).write.partitionBy("_batch").parquet(staged)
    arrivals = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_batch", T.IntegerType())])).parquet(staged)
    for i in range(n_batches):
        arrivals.where(F.col("_batch") == i).drop("_batch").write.mode("append").parquet(path)
        yield i


def run_available(stream_writer, checkpoint: str) -> None:
    """Start with the given checkpoint, process everything available, stop."""
    q = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint: str) -> DataFrame:
    """Incremental ingest of arriving Parquet batches into the raw zone
    (append): what has landed since the last call is one micro-batch. Returns
    the sink read back as a batch table."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    run_available(src.writeStream.format("parquet").option("path", sink_dir).outputMode("append"), checkpoint)
    return spark.read.schema(schema).parquet(sink_dir)


def hourly_volume_stream(events: DataFrame, ts: str = "transaction_timestamp", watermark: str = "1 hour") -> DataFrame:
    """Tumbling one-hour windows with a watermark (event time must be
    TIMESTAMP, not TIMESTAMP_NTZ, for a watermark)."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    return e.groupBy(F.window("_ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("volume"), F.avg("processing_time_ms").alias("latency_ms"),
        F.sum("prediction").cast("bigint").alias("fraud_detected"), F.avg("transaction_amount").alias("avg_amount"))


def run_hourly_volume(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint: str,
                      mode: str = "update", watermark: str = "1 hour", compact_every: int = 100) -> DataFrame:
    """T2 end to end: what has landed since the last call is one micro-batch.

    ``update`` publishes every hour a batch touched, ``append`` an hour once
    the watermark has passed it. In both the state of an hour goes when the
    watermark passes its end, and rows that come later are dropped. Each epoch
    is published once and whole (a replayed one is left as it is), readers
    take an hour from its newest epoch, and after ``compact_every`` epochs
    these are folded into one table."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    agg = hourly_volume_stream(src, watermark=watermark)

    def sink(batch: DataFrame, epoch: int) -> None:
        out = batch.select(F.col("w.start").cast("timestamp_ntz").alias("hour_start"), "volume", "latency_ms", "fraud_detected", "avg_amount")
        V.save_epoch(out, sink_dir, epoch)
        if epoch % compact_every == compact_every - 1:
            V.compact_epochs(spark, sink_dir, ["hour_start"])

    run_available(agg.writeStream.outputMode(mode).foreachBatch(sink), checkpoint)
    return V.read_epochs(spark, sink_dir, ["hour_start"])


def score_stream(features: DataFrame) -> DataFrame:
    """Stateless scoring of arriving feature rows (rule model)."""
    s = FE.score(features)
    return s.select("transaction_id", "prediction", round_to(F.col("score"), 4).alias("fraud_probability"),
                    F.when(F.col("score") > P.TIER_HIGH, "HIGH").when(F.col("score") > P.TIER_MEDIUM, "MEDIUM")
                    .otherwise("LOW").alias("risk_level"), F.lit("rule-v1.0").alias("model_version"))


def run_scoring(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, checkpoint: str) -> DataFrame:
    src = spark.readStream.schema(schema).parquet(source_dir)
    run_available(score_stream(src).writeStream.format("parquet").option("path", sink_dir).outputMode("append"), checkpoint)
    return spark.read.parquet(sink_dir)


def run_drift_per_batch(spark: SparkSession, baseline: DataFrame, source_dir: str, schema: T.StructType,
                        reports_dir: str, checkpoint: str) -> DataFrame:
    """T4: for every micro-batch of arriving scores (all that has landed since
    the last one), a drift report against the baseline scores, added to the
    ``drift_reports`` table. The baseline is counted once, before the stream
    starts; a batch reads its own rows and that one row. A report's folder is
    named by its epoch, so a replayed batch overwrites its own report."""
    base = materialize(D.baseline_counts(baseline), "baseline")
    src = spark.readStream.schema(schema).parquet(source_dir)

    def report(batch: DataFrame, epoch: int) -> None:
        counts = D.bin_counts(batch, base.select("lo", "hi"), extra=[F.count(F.lit(1)).alias("n"), F.avg("score").alias("current_mean")])
        out = D.with_drift(counts, base).select(
            "n", "psi", "kl_divergence", "current_mean", (F.col("psi") > P.PSI_DRIFT).alias("drift_detected"), D.severity(F.col("psi")).alias("severity"))
        out.write.mode("overwrite").parquet(f"{reports_dir}/batch_id={epoch}")

    run_available(src.writeStream.foreachBatch(report), checkpoint)
    return spark.read.parquet(reports_dir).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def new_paths(spark: SparkSession, name: str) -> tuple[str, str, str]:
    """(source, sink, checkpoint) folders under the shared checkpoint dir."""
    return scratch_path(spark, f"{name}-src"), scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
