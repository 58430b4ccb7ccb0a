"""Streaming: hours are emitted, updated, evicted and replayed as documented,
and every emitted window equals the batch aggregate."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from ledgerwatch.operators import analytics as A
from ledgerwatch.plans import base
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import versions as V
from ledgerwatch.streaming import jobs as S

HOURLY_SCHEMA = "transaction_timestamp timestamp_ntz, processing_time_ms double, prediction int, transaction_amount double"


def arrive(spark, src, *hours):
    """One arrival of transactions at half past the given hours."""
    rows = [(datetime(2024, 1, 1 + h // 24, h % 24, 30), 10.0, h % 2, 5.0) for h in hours]
    df = spark.createDataFrame(rows, HOURLY_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(src)
    return df.schema


def volumes(table):
    return {r["hour_start"].hour: r["volume"] for r in table.collect()}


def test_hourly_volume_append_mode_respects_watermark(spark):
    scored = S.materialize(base.scored(spark, SF_SMALL).select("transaction_timestamp", "processing_time_ms", "prediction", "transaction_amount"), "scored")
    src, out, ckpt = S.new_paths(spark, "hourly-append")
    for _ in S.land(scored, src, S.time_slices(scored, "transaction_timestamp", 4), 4):
        emitted = S.run_hourly_volume(spark, src, scored.schema, out, ckpt, mode="append")
    batch = A.hourly_volume(scored)
    n_emitted, n_batch = emitted.count(), batch.count()
    assert 0 < n_emitted < n_batch  # the newest windows wait for a later watermark
    j = emitted.join(batch.select("hour_start", F.col("volume").alias("b_volume")), "hour_start")
    assert j.count() == n_emitted
    assert j.where(F.col("volume") != F.col("b_volume")).count() == 0


@pytest.mark.parametrize("compact_every", [1, 100])
def test_hours_are_updated_and_rows_past_the_watermark_dropped(spark, compact_every):
    src, out, ckpt = S.new_paths(spark, "hourly-update")
    run = lambda schema: volumes(S.run_hourly_volume(spark, src, schema, out, ckpt, compact_every=compact_every))
    assert run(arrive(spark, src, 0, 1, 5)) == {0: 1, 1: 1, 5: 1}
    # hour 5 is still open; hour 0 ended more than an hour before the newest row
    assert run(arrive(spark, src, 5, 6, 0)) == {0: 1, 1: 1, 5: 2, 6: 1}
    assert run(arrive(spark, src, 9)) == {0: 1, 1: 1, 5: 2, 6: 1, 9: 1}


def test_a_replayed_epoch_changes_nothing(spark):
    root = scratch_path(spark, "epochs")
    rows = lambda *r: spark.createDataFrame(r, "k int, v string")
    assert V.save_epoch(rows((1, "a"), (2, "a")), root, 0)
    assert V.save_epoch(rows((2, "b"), (None, "b")), root, 1)
    assert not V.save_epoch(rows((2, "wrong")), root, 1)
    read = lambda: {(r["k"], r["v"]) for r in V.read_epochs(spark, root, ["k"]).collect()}
    assert read() == {(1, "a"), (2, "b"), (None, "b")}
    assert V.compact_epochs(spark, root, ["k"]) == 1
    assert read() == {(1, "a"), (2, "b"), (None, "b")}
    assert V.save_epoch(rows((1, "c")), root, 2)
    assert read() == {(1, "c"), (2, "b"), (None, "b")}
    with pytest.raises(FileNotFoundError):
        V.read_epochs(spark, scratch_path(spark, "none"), ["k"])


def test_every_arrival_lands_whole(spark):
    rows = spark.createDataFrame([(i, datetime(2024, 1, 1, i)) for i in range(8)] + [(None, None)], "id long, ts timestamp_ntz")
    for by in ("id", S.time_slices(rows, "ts", 4)):
        src = scratch_path(spark, "landed")
        counts = [spark.read.parquet(src).count() for _ in S.land(rows, src, by, 4)]
        assert counts == [3, 5, 7, 9]
        assert spark.read.parquet(src).exceptAll(rows).count() == 0
    empty, same = rows.limit(0), rows.where("id = 3")
    for df, n in ((empty, 0), (same, 1)):
        src = scratch_path(spark, "landed")
        assert [spark.read.parquet(src).count() for _ in S.land(df, src, S.time_slices(df, "ts", 4), 4)] == [n] * 4


def test_stream_scoring_equals_batch(spark):
    from ledgerwatch.operators import features as FE

    f = FE.engineer_features(base.tx(spark, SF_SMALL))
    src, out, ckpt = S.new_paths(spark, "scoring-test")
    for _ in S.land(f, src, "transaction_id", 3):
        streamed = S.run_scoring(spark, src, f.schema, out, ckpt)
    batch = S.score_stream(f)
    assert streamed.count() == batch.count() == f.count()
    assert streamed.exceptAll(batch).count() == 0
