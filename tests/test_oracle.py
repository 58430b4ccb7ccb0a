"""Every registered query with an oracle agrees with DuckDB on sf0.001
(row count, column names, values at 6 places)."""

import os

import duckdb
import pytest

from support import SF_SMALL
import __spark_entry__ as entry  # noqa: E402
from scripts.oracle_check import TABLES, rows_of

SLOW = {"model_comparison", "train_forest", "batch_scoring"}
# the training-data queries have tests of their own in tests/llm
SEPARATE = set(entry._training_data()[0])
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n not in SEPARATE}
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "rule_based_risk" in df.columns


def test_rows_only_queries_run(spark):
    for name in sorted(set(entry.queries()) - set(ORACLE) - SLOW - SEPARATE):
        assert entry.queries()[name](spark, SF_SMALL).count() > 0
