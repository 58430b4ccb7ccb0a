"""Gates, sources and sinks."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL, plan_text
from ledgerwatch.operators import quality as Q
from ledgerwatch.plans import base
from ledgerwatch.sources import files as FS
from ledgerwatch.sources.tables import TRANSACTIONS_SCHEMA


def test_quality_gate_fails_on_imbalance(spark):
    g = Q.data_quality_gate(base.tx(spark, SF_SMALL)).first()
    assert not g["passed"]
    assert any("Class imbalance" in v for v in g["violations"])


def test_notebook_risk_breaks_range_check(spark):
    suite = {r["check_id"]: r for r in Q.expectation_suite(base.features(spark, SF_SMALL)).collect()}
    assert suite[6]["success"] is False and suite[6]["unexpected_count"] > 0


def test_resolve_source_fallback(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    pq = os.path.join(d, "raw.parquet")
    base.tx(spark, SF_SMALL).write.parquet(pq)
    df = FS.resolve_source(spark, [("csv", os.path.join(d, "missing.csv")), ("parquet", pq)], TRANSACTIONS_SCHEMA)
    assert df.count() == 1000
    with pytest.raises(FileNotFoundError):
        FS.resolve_source(spark, [("csv", os.path.join(d, "nope.csv"))], TRANSACTIONS_SCHEMA)


def test_partition_pruning_on_version(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    path, log = os.path.join(d, "fs"), os.path.join(d, "log")
    f = base.features(spark, SF_SMALL).withColumn("feature_version", F.lit("v1.0"))
    FS.write_features(f, path, log)
    FS.write_features(f.withColumn("feature_version", F.lit("v2")), path, log)
    df = FS.read_feature_store(spark, path, "v1.0")
    plan = plan_text(df)
    assert "PartitionFilters" in plan and "v1.0" in plan
    assert df.count() == 1000
    hist = FS.write_history(spark, log).collect()
    assert [r["version"] for r in hist] == [1, 0] and all(r["rows"] == 1000 for r in hist)


def test_synthetic_is_repeatable(spark):
    ids = spark.range(1000)
    a = FS.synthetic_transactions(ids).agg(F.sum("is_fraud")).first()[0]
    b = FS.synthetic_transactions(ids).agg(F.sum("is_fraud")).first()[0]
    assert a == b and 5 <= a <= 60
