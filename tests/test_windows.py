"""Bucketed (skew-safe) windows equal the plain window forms."""

from pyspark.sql import functions as F

from support import SF_MID
from ledgerwatch.operators import features as FE
from ledgerwatch.sources import tables as T

COLS = ["transaction_id", "tx_count_7d", "avg_amount_30d", "merchant_count_30d"]


def _mismatch(a, b, cols):
    j = a.join(b.select("transaction_id", *[F.col(c).alias(f"b_{c}") for c in cols if c != "transaction_id"]),
               "transaction_id")
    cond = None
    for c in cols:
        if c == "transaction_id":
            continue
        x, y = F.col(c), F.col(f"b_{c}")
        diff = (F.abs(x - y) > 1e-9) | (x.isNull() != y.isNull())
        cond = diff if cond is None else cond | diff
    return j.where(cond).count()


def test_trailing_equal_on_orders(spark):
    tx = T.orders_as_transactions(spark, SF_MID)
    a = FE.trailing_features(tx, "window").select(*COLS)
    b = FE.trailing_features(tx, "bucketed").select(*COLS)
    assert a.count() == b.count() == tx.count()
    assert _mismatch(a, b, COLS) == 0


def test_trailing_equal_with_hot_customer(spark):
    """A third of all rows belong to one customer."""
    tx = T.transactions(spark, SF_MID).withColumn(
        "customer_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_id")))
    a = FE.trailing_features(tx, "window").select(*COLS)
    b = FE._trailing_bucketed(tx, bucket_us=3_600_000_000).select(*COLS)
    assert _mismatch(a, b, COLS) == 0
    # adaptive widths: keys above 200 rows are cut into ~200-row buckets
    c = FE._trailing_bucketed(tx, target_rows=200).select(*COLS)
    assert _mismatch(a, c, COLS) == 0


def test_adaptive_width_bounds_hot_key(spark):
    from ledgerwatch.operators import windows as W

    tx = T.transactions(spark, SF_MID).withColumn(
        "customer_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_id")))
    us = W.epoch_us("transaction_timestamp")
    widths = W.bucket_widths(tx, "customer_id", us, 200).collect()
    assert [r["_k"] for r in widths] == [-1]
    per_bucket = tx.where(F.col("customer_id") == -1).groupBy(F.floor(us / F.lit(widths[0]["_w"]))).count()
    assert per_bucket.agg(F.max("count")).first()[0] <= 4 * 200


def test_prior_mean_and_first_activity_equal(spark):
    tx = T.orders_as_transactions(spark, SF_MID)
    pa = FE.prior_mean_amount(tx, "window").select("transaction_id", "avg_amount_prior")
    pb = FE.prior_mean_amount(tx, "bucketed").select("transaction_id", "avg_amount_prior")
    assert _mismatch(pa, pb, ["transaction_id", "avg_amount_prior"]) == 0
    qa = FE.first_activity(tx, "window").select("transaction_id", "is_first_activity")
    qb = FE.first_activity(tx, "bucketed").select("transaction_id", "is_first_activity")
    assert _mismatch(qa, qb, ["transaction_id", "is_first_activity"]) == 0


def test_hand_sized_edges(spark):
    """Ties, a single-row customer, null merchants."""
    rows = [
        (1, 1, "2024-01-01 00:00:00", 10.0, "a"),
        (2, 1, "2024-01-01 00:00:00", 20.0, None),
        (3, 1, "2024-01-08 00:00:00", 30.0, "b"),
        (4, 1, "2024-01-08 00:00:01", 40.0, None),
        (5, 2, "2024-02-01 12:00:00", 5.0, None),
        (6, 1, "2024-03-01 00:00:00", 1.0, "c"),
    ]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, ts string, transaction_amount double, "
                                     "merchant_id string").withColumn(
        "transaction_timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts")
    a = FE.trailing_features(df, "window").select(*COLS)
    b = FE.trailing_features(df, "bucketed").select(*COLS)
    assert _mismatch(a, b, COLS) == 0
    got = {r.transaction_id: r for r in b.collect()}
    assert got[3].tx_count_7d == 3          # frame start is inclusive: 2024-01-01 00:00:00
    assert got[4].tx_count_7d == 2
    assert got[5].merchant_count_30d == 0    # only a null merchant
    assert got[6].tx_count_7d == 1
