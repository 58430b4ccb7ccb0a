"""Tables whose schema grows, the newest batch, saved tables."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import plan_text
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import files as FS
from ledgerwatch.sources import versions as V


def version(spark, name, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("feature_version", F.lit(name))


def test_versions_with_other_columns_and_types_are_read_as_one_table(spark):
    path, log = scratch_path(spark, "fs"), scratch_path(spark, "fs-log")
    FS.write_features(version(spark, "a", [(1, 1, 0.5, Decimal("1.25"), None), (None, None, None, None, None)],
                              "id long, n int, x float, d decimal(6,2), day date"), path, log)
    FS.write_features(version(spark, "b", [(1, 1 << 40, 1e300, Decimal("123456.125"), datetime(2024, 1, 1, 5), "new")],
                              "id long, n long, x double, d decimal(12,3), day timestamp_ntz, extra string"), path, log)
    FS.write_features(version(spark, "a", [(2,)], "id long"), path, log)
    t = FS.read_feature_store(spark, path)
    assert {f.name: f.dataType.simpleString() for f in t.schema.fields} == {
        "id": "bigint", "n": "bigint", "x": "double", "d": "decimal(12,3)", "day": "timestamp_ntz", "feature_version": "string", "extra": "string"}
    rows = {(r["feature_version"], r["id"], r["n"], r["x"], r["d"], r["day"], r["extra"]) for r in t.collect()}
    assert rows == {("a", 1, 1, 0.5, Decimal("1.250"), None, None), ("a", None, None, None, None, None, None), ("a", 2, None, None, None, None, None),
                    ("b", 1, 1 << 40, 1e300, Decimal("123456.125"), datetime(2024, 1, 1, 5), "new")}
    assert FS.read_feature_store(spark, path, "a").count() == 3
    assert len(V.versions(spark, f"{path}/_schema")) == 2      # the third write brought nothing new
    assert [r["rows"] for r in FS.write_history(spark, log).collect()] == [1, 1, 2]


def test_rows_that_do_not_fit_are_refused_before_they_are_written(spark):
    path, log = scratch_path(spark, "fs"), scratch_path(spark, "fs-log")
    FS.write_features(version(spark, "a", [(1, "x")], "id long, c string"), path, log)
    with pytest.raises(ValueError, match="column c"):
        FS.write_features(version(spark, "b", [(1, 2)], "id long, c int"), path, log)
    with pytest.raises(ValueError, match="column id"):
        FS.write_features(version(spark, "b", [(1.5, "x")], "id double, c string"), path, log)   # a long doesn't fit a double
    assert FS.read_feature_store(spark, path).count() == 1


def test_wider_types():
    assert FS.wider_type(T.ShortType(), T.LongType()) == T.LongType()
    assert FS.wider_type(T.DecimalType(10, 2), T.DecimalType(12, 4)) == T.DecimalType(12, 4)
    assert FS.wider_type(T.DecimalType(10, 2), T.DecimalType(10, 4)) is None
    assert FS.wider_type(T.LongType(), T.DoubleType()) is None
    assert FS.wider_type(T.StringType(), T.StringType()) == T.StringType()


def test_concurrent_writers_keep_each_others_columns(spark):
    from concurrent.futures import ThreadPoolExecutor

    path, log = scratch_path(spark, "fs"), scratch_path(spark, "fs-log")
    frames = [version(spark, f"v{i}", [(i, i)], f"id long, c{i} long") for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda f: FS.write_features(f, path, log), frames))
    t = FS.read_feature_store(spark, path)
    assert {"c0", "c1", "c2", "c3"} <= set(t.columns)
    assert {(r["id"], r[f"c{r['id']}"]) for r in t.collect()} == {(i, i) for i in range(4)}
    assert len(FS.write_history(spark, log).collect()) == 4


def test_the_newest_dated_batch_is_one_partition(spark):
    path = scratch_path(spark, "dated")
    with pytest.raises(FileNotFoundError):
        FS.latest_batch(spark, path)
    rows = [(i, datetime(2024, 1, 1 + i // 4, 3)) for i in range(10)] + [(99, None)]
    FS.write_dated(spark.createDataFrame(rows, "id long, transaction_timestamp timestamp_ntz"), path)
    b = FS.latest_batch(spark, path)
    assert {r["id"] for r in b.collect()} == {8, 9}
    plan = plan_text(b)
    assert "PartitionFilters: [isnotnull(batch_date" in plan and "2024-01-03" in plan


def test_the_newest_arrival_is_the_only_one_opened(spark):
    path = scratch_path(spark, "arrived")
    rows = spark.createDataFrame([(i,) for i in range(3)], "id long")
    with pytest.raises(FileNotFoundError):
        FS.newest_arrival(spark, path, rows.schema)
    for i, name in enumerate(("z", "a", "_tmp")):
        rows.where(F.col("id") == i).coalesce(1).write.parquet(f"{path}/{name}")
    b = FS.newest_arrival(spark, path, rows.schema)
    assert [r["id"] for r in b.collect()] == [1]
    assert all("/a/" in f for f in b.inputFiles())


def test_a_saved_table_is_replaced(spark):
    one = spark.range(3)
    FS.save_as_table(one, "lw_saved", scratch_path(spark, "table"))
    before = spark.table("lw_saved")
    FS.save_as_table(spark.range(5), "lw_saved", scratch_path(spark, "table"))
    assert spark.sql("SELECT * FROM lw_saved").count() == 5
    assert before.count() == 3          # who began to read the old one can finish
    assert FS.resolve_source(spark, [("table", "lw_saved")], one.schema).count() == 5
