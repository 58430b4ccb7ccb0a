"""Repeated and null ids, null and hot keys, wide ids, shared folders."""

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions.scalars import padded_id
from ledgerwatch.operators import features as FE
from ledgerwatch.session import ensure_checkpoint_dir
from ledgerwatch.sources.files import synthetic_transactions


def _rows(spark):
    data = [(i % 90 if i % 17 else None, (0 if i % 3 else i % 5) if i % 29 else None, i % 4 if i % 7 else None, i * 40_000, float(i % 13) if i % 11 else None) for i in range(600)]
    return spark.createDataFrame(data, "transaction_id long, customer_id long, merchant_id long, s long, transaction_amount double").withColumn(
        "transaction_timestamp", F.timestamp_seconds(F.col("s") + 1_600_000_000).cast("timestamp_ntz")).drop("s")


def test_split_windows_equal_plain_on_repeated_and_null_ids(spark):
    df = _rows(spark)
    cols = ["transaction_id", "customer_id", "transaction_timestamp", "tx_count_7d", "merchant_count_30d", F.round("avg_amount_30d", 6)]
    plain = FE.trailing_features(df, "window").select(*cols)
    split = FE.trailing_features(df, hot_rows=100).select(*cols)
    assert plain.count() == split.count() == 600
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_wide_ids_stay_whole(spark):
    df = spark.createDataFrame([(42,), (12345678,), (12345679,), (2_000_000_000,)], "id long")
    assert [r[0] for r in df.select(padded_id("TX-", F.col("id"), 7)).collect()] == ["TX-0000042", "TX-12345678", "TX-12345679", "TX-2000000000"]
    made = synthetic_transactions(df)
    assert made.select("transaction_id").distinct().count() == 4 and made.where("transaction_timestamp is null").isEmpty()


def test_machine_local_folder_is_refused_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_wide_and_null_ids_are_split(spark):
    from ledgerwatch.operators.modelling import stratified_split

    df = spark.createDataFrame([(i * 2_000_000_000_000_003 if i else None, i % 2) for i in range(100)], "transaction_id long, is_fraud int")
    assert {(r["is_fraud"], r["split"]): r["count"] for r in stratified_split(df).groupBy("is_fraud", "split").count().collect()} == {
        (0, "test"): 10, (0, "train"): 40, (1, "test"): 10, (1, "train"): 40}


def test_class_rank_of_rows_without_id(spark):
    """A third of the rows without id, some ids repeated, a null class."""
    from ledgerwatch.operators.modelling import split_key, with_class_rank

    rows = [(None if i % 3 == 0 else i // 2, None if i % 10 == 9 else i % 2, i) for i in range(900)]
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud int, place int")
    got = with_class_rank(df).withColumn("key", split_key("transaction_id")).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"transaction_id", "is_fraud", "place", "_rank", "_n", "key"}
    for y in (0, 1, None):
        mine = sorted((r for r in got if r.is_fraud == y), key=lambda r: r["_rank"])
        assert [r["_rank"] for r in mine] == list(range(1, len(mine) + 1)) and {r["_n"] for r in mine} == {len(mine)}
        order = [(r["key"], -1 if r.transaction_id is None else r.transaction_id) for r in mine]
        assert order == sorted(order)


def test_consecutive_drift_rule(spark):
    from ledgerwatch.operators.drift import consecutive_drift

    days = [("2024-01-01", 0.3), ("2024-01-02", 0.26), ("2024-01-03", 0.9), ("2024-01-04", 0.25), ("2024-01-05", 0.4), ("2024-01-06", 0.4)]
    df = spark.createDataFrame(days, "d string, psi double").withColumn("report_date", F.to_date("d"))
    found = [(str(r["run_start"]), str(r["run_end"]), r["days"]) for r in consecutive_drift(df, threshold=0.25).collect()]
    assert found == [("2024-01-01", "2024-01-03", 3)]


def test_repeated_ids_are_explained_once_each(spark):
    from support import SF_SMALL
    from ledgerwatch.operators import explain as X
    from ledgerwatch.plans import base

    one = base.scored(spark, SF_SMALL).where("score > 0.65").limit(1)
    twice = one.unionByName(one)
    assert X.explain_text(twice).count() == X.explain_analyst(twice).count() == 2


def test_unreadable_source_is_not_skipped(spark, tmp_path):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from ledgerwatch.sources.files import resolve_source

    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    schema = spark.range(1).schema
    assert resolve_source(spark, [("table", "no_such_table"), ("parquet", good)], schema).count() == 3
    with pytest.raises((PySparkException, Py4JJavaError)):
        resolve_source(spark, [("nonsense", good), ("parquet", good)], schema)


def test_fairness_without_groups_is_skipped(spark):
    from ledgerwatch.operators.evaluation import fairness_gate

    row = fairness_gate(spark.createDataFrame([], "age_band string, is_fraud int, prediction int")).first()
    assert row["status"] == "skipped" and row["passed"]


def test_replayed_drift_batch_gives_the_same_table(spark):
    from ledgerwatch.streaming import jobs as S

    rows = spark.range(400).selectExpr("id as transaction_id", "id % 100 / 100 as score")
    src, out, ckpt = S.new_paths(spark, "replay")
    for _ in S.land(rows, src, "transaction_id", 2):
        reports = S.run_drift_per_batch(spark, rows, src, rows.schema, out, ckpt)
    assert [tuple(r) for r in reports.select("batch_id", "n").orderBy("batch_id").collect()] == [(0, 200), (1, 200)]
    again = S.run_drift_per_batch(spark, rows, src, rows.schema, out, S.scratch_path(spark, "replay-ckpt"))
    assert again.where("batch_id = 0").count() == 1 and again.count() == 2
