"""Plan checks: pushdown and pruning at the scan, no Python in SQL-tier
plans, bounded broadcasts, one shuffle for the plain windows."""

import pytest

from support import SF_SMALL, plan_text
from ledgerwatch.operators import features as FE
from ledgerwatch.plans import registry
from ledgerwatch.sources import tables as T

registry.load_all()


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F

    df = T.read_table(spark, SF_SMALL, "events").where(F.col("value") > 100).select("event_id", "value")
    p = plan_text(df)
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_plain_windows_share_one_exchange(spark):
    p = plan_text(FE.trailing_features(T.transactions(spark, SF_SMALL), "window")
                  .select("transaction_id", "tx_count_7d", "avg_amount_30d", "merchant_count_30d"))
    assert p.count("hashpartitioning(customer_id") == 1, p
    assert p.count("Window (") == 1  # all three frames computed by one Window operator after one sort


def test_nation_is_broadcast_customer_is_not_forced(spark):
    p = plan_text(T.transactions(spark, SF_SMALL))
    assert "BroadcastExchange" in p


@pytest.mark.parametrize("name", ["feature_table", "psi", "roc_auc", "segmentation_long", "explain_text",
                                  "stratified_split", "kpi_summary", "drift_reports"])
def test_no_python_workers_in_sql_tier_plans(spark, name):
    p = plan_text(registry.QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name} runs Python: {node}"
