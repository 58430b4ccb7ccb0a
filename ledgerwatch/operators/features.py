"""Feature engineering over a transactions frame: trailing-time windows per
customer, derived flags and the rule-based risk score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import params as P
from ..session import materialize
from . import windows as W

KEY, TS, ID, AMT, MERCH = ("customer_id", "transaction_timestamp", "transaction_id",
                           "transaction_amount", "merchant_id")
ROW = "_row_number"
EXACT_BELOW = 1e9            # amounts below are summed as decimals; what a decimal can't hold is summed as a double


def clip(c: Column, lo: float, hi: float) -> Column:
    """Clip with null passing through (``least``/``greatest`` skip nulls)."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def _trailing_plain(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Plain windows: one Exchange on ``key`` and one sort serve both frames."""
    frame = "PARTITION BY {k} ORDER BY {t} RANGE BETWEEN INTERVAL {d} DAYS PRECEDING AND CURRENT ROW"
    w7 = frame.format(k=key, t=ts, d=7)
    w30 = frame.format(k=key, t=ts, d=30)
    return df.select(
        "*",
        F.expr(f"count({ID}) OVER ({w7})").alias("tx_count_7d"),
        F.expr(f"avg({AMT}) OVER ({w30})").alias("avg_amount_30d"),
        F.expr(f"count({MERCH}) OVER ({w30})").alias("merchant_count_30d"),
    )


def _numbered(df: DataFrame) -> DataFrame:
    """The rows with a number of their own, written so that it holds: the
    split paths join their sums back by it, whatever the transaction ids."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _by_heat(df: DataFrame, key: str, plain, split, hot_rows: int = W.TARGET_ROWS_PER_BUCKET) -> DataFrame:
    """``plain`` (one shuffle) for the rows of ordinary keys and ``split`` for
    those of keys with more than ``hot_rows`` rows (null a key like another),
    found by one partial aggregation. Both give the same values, but for the
    order in which doubles are added."""
    hot = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows).select("_hot")
    if hot.isEmpty():
        return plain(df)
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return plain(df.join(hot, same, "left_anti")).unionByName(split(df.join(hot, same, "left_semi")))


def _present(column: str) -> tuple[Column, str]:
    return F.when(F.col(column).isNotNull(), 1).otherwise(0), "bigint"


def _amount_measures(amount: str = AMT) -> dict[str, tuple[Column, str]]:
    """Additive measures whose differences give a mean like that of plain
    doubles: a decimal sum, the doubles' rest beyond it, and counts of amounts,
    NaN and either infinity."""
    x = F.col(amount).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    exact = F.when(finite & (F.abs(x) < EXACT_BELOW), x).otherwise(F.lit(0.0)).cast("decimal(38,18)")
    return {
        "amt": (exact, "decimal(38,18)"), "rest": (F.when(finite, x - exact.cast("double")).otherwise(F.lit(0.0)), "double"),
        "namt": _present(amount), "nan": (F.when(F.isnan(x), 1).otherwise(0), "bigint"),
        "up": (F.when(x == float("inf"), 1).otherwise(0), "bigint"), "down": (F.when(x == float("-inf"), 1).otherwise(0), "bigint"),
    }


def _mean_amount(suffix: str = "") -> Column:
    """The mean from the sums of ``_amount_measures``; null without amounts."""
    amt, rest, n, nan, up, down = (F.col(f"{m}{suffix}") for m in ("amt", "rest", "namt", "nan", "up", "down"))
    mean = (F.when((nan > 0) | ((up > 0) & (down > 0)), float("nan")).when(up > 0, float("inf")).when(down > 0, float("-inf"))
            .otherwise((amt.cast("double") + rest) / n))
    return F.when(n > 0, mean)


def _trailing_measures() -> dict[str, tuple[Column, str]]:
    return {"n": _present(ID), "nm": _present(MERCH), **_amount_measures()}


def _trailing_split(df: DataFrame, sums) -> DataFrame:
    df = _numbered(df)
    narrow = sums(df).select(ROW, F.col("n_7d").alias("tx_count_7d"), _mean_amount("_30d").alias("avg_amount_30d"), F.col("nm_30d").alias("merchant_count_30d"))
    return df.join(narrow, ROW, "left").drop(ROW)


def _trailing_ranged(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    return _trailing_split(df, lambda d: W.trailing_ranged(d, key, ts, ROW, _trailing_measures(), {"7d": 7, "30d": 30}))


def _trailing_bucketed(df: DataFrame, key: str = KEY, ts: str = TS, bucket_us: int | None = W.DEFAULT_BUCKET_US,
                       target_rows: int = W.TARGET_ROWS_PER_BUCKET) -> DataFrame:
    return _trailing_split(df, lambda d: W.trailing_sums(
        d, key, ts, ROW, measures=_trailing_measures(), spans_days={"7d": 7, "30d": 30}, bucket_us=bucket_us, target_rows=target_rows))


def trailing_features(df: DataFrame, method: str = "auto", key: str = KEY, ts: str = TS,
                      hot_rows: int = W.TARGET_ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``tx_count_7d`` (W1), ``avg_amount_30d`` (W2) and
    ``merchant_count_30d`` (W3's count) to every row.

    ``method="auto"`` (default) takes the plain single-Exchange window, and for
    customers with more than ``hot_rows`` rows the ranged one, whose tasks stay
    bounded even in a burst of one instant; ``"window"``, ``"ranged"`` and
    ``"bucketed"`` (time buckets) take one of them for all rows.
    """
    if method == "auto":
        return _by_heat(df, key, lambda d: _trailing_plain(d, key, ts), lambda d: _trailing_ranged(d, key, ts), hot_rows)
    if method == "window":
        return _trailing_plain(df, key, ts)
    if method == "ranged":
        return _trailing_ranged(df, key, ts)
    if method == "bucketed":
        return _trailing_bucketed(df, key, ts)
    raise ValueError(f"unknown method {method!r}")


def rule_risk(dev: Column, new: Column, cross: Column, tx7: Column, variant: str = "notebook",
              weights: tuple[float, float, float, float] | None = None) -> Column:
    """Weighted rule score. ``notebook``: unclipped; ``local``: deviation
    clipped to [0, 3] first and the sum clipped to [0, 1]."""
    vel = F.when(tx7 > P.VELOCITY_LIMIT_7D, 1.0).otherwise(0.0)
    if variant == "notebook":
        w = weights or P.RISK_WEIGHTS_NOTEBOOK
        return dev * w[0] + new * w[1] + cross * w[2] + vel * w[3]
    if variant == "local":
        w = weights or P.RISK_WEIGHTS_LOCAL
        return clip(clip(dev, 0.0, P.LOCAL_DEVIATION_CLIP) * w[0] + new * w[1] + cross * w[2] + vel * w[3], 0.0, 1.0)
    raise ValueError(f"unknown variant {variant!r}")


def derived_features(df: DataFrame) -> DataFrame:
    """P3–P7 on top of the trailing windows."""
    dev = F.col(AMT) / (F.col("avg_amount_30d") + F.lit(P.AMOUNT_DEVIATION_EPS))
    new = (F.col("merchant_count_30d") == 1).cast("int")
    cross = F.when(F.col("merchant_country") != F.col("customer_country"), 1).otherwise(0)
    return df.select(
        "*", dev.alias("amount_deviation_ratio"), F.hour(TS).alias("hour_of_day"),
        F.dayofweek(TS).isin(1, 7).cast("int").alias("is_weekend"), new.alias("is_new_merchant"),
        cross.alias("is_cross_border"), rule_risk(dev, new, cross, F.col("tx_count_7d")).alias("rule_based_risk"))


def engineer_features(tx: DataFrame, method: str = "auto") -> DataFrame:
    """All feature columns (and the source columns) for every transaction."""
    return derived_features(trailing_features(tx, method))


def feature_table(tx: DataFrame, method: str = "auto", version: str = P.FEATURE_VERSION,
                  tolerant: bool = False) -> DataFrame:
    """The 19 feature-store columns in their fixed order."""
    f = engineer_features(tx, method).withColumn("feature_version", F.lit(version)) \
        .withColumn("feature_timestamp", F.current_timestamp())
    cols = [c for c in P.FEATURE_COLUMNS if c in f.columns] if tolerant else P.FEATURE_COLUMNS
    return f.select(*cols)


def score(df: DataFrame, threshold: float = P.DECISION_THRESHOLD) -> DataFrame:
    """``score`` = notebook risk clipped to [0, 1]; ``prediction`` = score > threshold."""
    sc = clip(F.col("rule_based_risk"), 0.0, 1.0)
    return df.select("*", sc.alias("score"), (sc > F.lit(threshold)).cast("int").alias("prediction"))


def scored_transactions(tx: DataFrame, method: str = "auto") -> DataFrame:
    return score(engineer_features(tx, method))


# --- local-script variants -----------------------------------------------------

def prior_mean_amount(df: DataFrame, method: str = "auto", key: str = KEY, ts: str = TS, hot_rows: int = W.TARGET_ROWS_PER_BUCKET) -> DataFrame:
    """Mean of all earlier rows of the customer (order ts, id); the first
    row takes the customer's whole-history mean. Adds ``avg_amount_prior``."""
    if method == "auto":
        return _by_heat(df, key, lambda d: prior_mean_amount(d, "window", key, ts), lambda d: prior_mean_amount(d, "bucketed", key, ts), hot_rows)
    if method == "window":
        w = Window.partitionBy(key).orderBy(ts, ID).rowsBetween(Window.unboundedPreceding, -1)
        out = df.withColumn("_prior", F.avg(AMT).over(w)).withColumn("_cust_mean", F.avg(AMT).over(Window.partitionBy(key)))
        return out.withColumn("avg_amount_prior", F.coalesce("_prior", "_cust_mean")).drop("_prior", "_cust_mean")
    df = _numbered(df)
    sums = W.running_ranged(df, key, [ts, ID, ROW], ROW, _amount_measures(), include_current=False)
    sums = sums.select(ROW, F.coalesce(_mean_amount(), _mean_amount("_all")).alias("avg_amount_prior"))
    return df.join(sums, ROW, "left").drop(ROW)


def first_activity(df: DataFrame, method: str = "auto", key: str = KEY, ts: str = TS, hot_rows: int = W.TARGET_ROWS_PER_BUCKET) -> DataFrame:
    """1 where the running count of non-null merchants (order ts, id)
    equals one. Adds ``is_first_activity``."""
    if method == "auto":
        return _by_heat(df, key, lambda d: first_activity(d, "window", key, ts), lambda d: first_activity(d, "bucketed", key, ts), hot_rows)
    if method == "window":
        w = Window.partitionBy(key).orderBy(ts, ID).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn("is_first_activity", (F.count(MERCH).over(w) == 1).cast("int"))
    df = _numbered(df)
    sums = W.running_ranged(df, key, [ts, ID, ROW], ROW, {"_c": _present(MERCH)}, include_current=True).select(ROW, "_c")
    return df.join(sums, ROW, "left").withColumn("is_first_activity", (F.col("_c") == 1).cast("int")).drop("_c", ROW)


def first_at_merchant(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """1 for the customer's first transaction at each merchant (as the
    feature is described; order ts, id), for one row only where these repeat.
    Adds ``is_first_at_merchant``."""
    df = _numbered(df)
    firsts = df.groupBy(key, MERCH).agg(F.min(F.struct(ts, ID, ROW)).alias("_m")).select(F.col(f"_m.{ROW}").alias(ROW), F.lit(1).alias("is_first"))
    return df.join(firsts, ROW, "left").withColumn("is_first_at_merchant", F.coalesce("is_first", F.lit(0))).drop("is_first", ROW)
