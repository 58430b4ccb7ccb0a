"""Per-key trailing-time and running aggregates that stay balanced when one
key holds a large share of all rows.

A plain ``OVER (PARTITION BY key ORDER BY ts RANGE ...)`` window puts every
row of a key into one task. Here each key is split into time buckets and
every frame is answered as a difference of prefix sums:

    sum over [t - span, t]  =  P(t) - P(t - span - 1us)
    P(x) = (sum of whole buckets before bucket(x))      -- small per-key table
         + (running sum inside bucket(x) up to x)        -- window per (key, bucket)

The probe point ``t - span - 1us`` is answered in its own bucket, next to the
rows it has to count, and joined back to its row by the row's written number.

Bucket widths adapt per key: an ordinary key is one bucket (the work is
then that of a plain window); a key with more than ``target_rows`` rows is
cut into power-of-two time buckets of about ``target_rows`` rows.

Time buckets can't cut a burst of one instant, so hot keys take
``trailing_ranged`` and ``running_ranged`` instead: points are range-sorted by
(key, time, row), whose boundaries Spark draws from row quantiles, every range
sums its own rows, and range totals (a row per range and key) are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

US_PER_DAY = 86_400_000_000
# Bucket width of an ordinary key: one bucket spans its whole history.
WHOLE_KEY_US = 1 << 52
# A key with more rows than this is split into time buckets of about this
# many rows each.
TARGET_ROWS_PER_BUCKET = 1_000_000
DEFAULT_BUCKET_US = None  # adaptive


def bucket_widths(df: DataFrame, key: str, us: Column, target_rows: int) -> DataFrame:
    """(``_k``, ``_w``) for hot keys only: keys with more than ``target_rows``
    rows get a power-of-two bucket width (µs) sized so that a bucket holds
    about ``target_rows`` rows. The table has at most n / target_rows rows —
    a bound by construction — so it is broadcast."""
    st = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.min(us).alias("_lo"),
                                                F.max(us).alias("_hi"))
    span = (F.col("_hi") - F.col("_lo") + 1).cast("double")
    w = F.pow(F.lit(2.0), F.floor(F.log2(span * F.lit(float(target_rows)) / F.col("_n"))))
    return F.broadcast(st.where(F.col("_n") > target_rows).select(
        "_k", F.greatest(F.lit(1), w.cast("bigint")).alias("_w")))


def with_width(df: DataFrame, key: str, us: Column, bucket_us: int | None, target_rows: int) -> DataFrame:
    """Adds ``_w``, the bucket width of the row's key: fixed when
    ``bucket_us`` is given, else adaptive (whole key, or split when hot)."""
    if bucket_us is not None:
        return df.withColumn("_w", F.lit(bucket_us).cast("bigint"))
    hot = bucket_widths(df, key, us, target_rows)
    return df.join(hot, F.col(key) == F.col("_k"), "left").drop("_k") \
        .withColumn("_w", F.coalesce(F.col("_w"), F.lit(WHOLE_KEY_US).cast("bigint")))


def epoch_us(ts_col: str) -> Column:
    """Microseconds since the epoch; TIMESTAMP_NTZ goes through TIMESTAMP
    (session time zone UTC)."""
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def trailing_sums(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    measures: dict[str, Column],
    spans_days: dict[str, int],
    bucket_us: int | None = DEFAULT_BUCKET_US,
    target_rows: int = TARGET_ROWS_PER_BUCKET,
) -> DataFrame:
    """Narrow result ``(row_id, <measure>_<span> ...)``: for every row and
    every (measure, span) the sum of the measure over the key's rows with
    ``ts`` in ``[ts_row - span days, ts_row]`` (ties included).

    ``measures`` maps a name to (additive column, its SQL type), e.g. a
    ``bigint`` count or a ``decimal(38,8)`` amount; ``spans_days`` maps a
    suffix to a frame length in days.
    """
    names = list(measures)
    zero = {m: F.lit(0).cast(measures[m][1]) for m in names}
    us = epoch_us(ts)
    df = with_width(df, key, us, bucket_us, target_rows)
    # One pass over the input: each row becomes its own point plus one
    # zero-weight probe per span just before its frame start (explode, no
    # union of re-scans).
    kinds = [F.struct(F.lit("_now").alias("kind"), us.alias("us"), F.lit(True).alias("real"))]
    for suffix, days in spans_days.items():
        kinds.append(F.struct(F.lit(suffix).alias("kind"), (us - F.lit(days * US_PER_DAY + 1)).alias("us"),
                              F.lit(False).alias("real")))
    pts = df.select(F.col(key).alias("_k"), F.col(row_id).alias("_id"), "_w",
                    *[measures[m][0].cast(measures[m][1]).alias(m) for m in names],
                    F.explode(F.array(*kinds)).alias("_p"))
    allp = pts.select("_k", "_id", F.col("_p.kind").alias("_kind"), F.col("_p.us").alias("_us"),
                      F.floor(F.col("_p.us") / F.col("_w")).alias("_b"),
                      *[F.when(F.col("_p.real"), F.col(m)).otherwise(zero[m]).alias(m) for m in names])
    # One window stage per (key, bucket): the running sum up to each point
    # and the bucket's total (same partitioning and order, one sort).
    part = Window.partitionBy("_k", "_b")
    w_in = part.orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    inside = allp.select("_k", "_b", "_id", "_kind",
                         *[F.sum(m).over(w_in).alias(f"_in_{m}") for m in names],
                         *[F.sum(m).over(part).alias(f"_tot_{m}") for m in names])
    # Per key, the sum over all earlier buckets (probe buckets included);
    # grouping on the window's own keys needs no new shuffle, and the table
    # has (time span / bucket width) rows per key.
    totals = inside.groupBy("_k", "_b").agg(*[F.max(f"_tot_{m}").alias(m) for m in names])
    w_before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "_k", "_b",
        *[F.coalesce(F.sum(m).over(w_before), zero[m]).alias(f"_pre_{m}") for m in names],
    )
    prefix = inside.join(before, ["_k", "_b"], "left").select(
        "_id", "_kind",
        *[(F.col(f"_in_{m}") + F.coalesce(F.col(f"_pre_{m}"), zero[m])).alias(f"_p_{m}")
          for m in names],
    )
    # One row per id: P(now) - P(probe) for every span.
    aggs = []
    for suffix in spans_days:
        for m in names:
            now = F.sum(F.when(F.col("_kind") == "_now", F.col(f"_p_{m}")))
            edge = F.sum(F.when(F.col("_kind") == suffix, F.col(f"_p_{m}")))
            aggs.append((now - edge).alias(f"{m}_{suffix}"))
    return prefix.groupBy(F.col("_id").alias(row_id)).agg(*aggs)


def ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-sorted by ``order`` and written, with ``_spot``, which
    grows along that order, and ``_part``, the range of a row. Equal rows of the
    order share a range, so end it with a number of the row."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_spot", F.monotonically_increasing_id())
    return materialize(rows.withColumn("_part", F.shiftright("_spot", 33)), name)


def prefix_sums(df: DataFrame, keys: list[str], order: list[Column], measures: list[str], name: str = "prefix") -> DataFrame:
    """``df`` with ``_before_<measure>``: the sum of each measure over the rows
    of the same ``keys`` (null a key like another) earlier in ``order``.

    Each range sums its own rows in order; the totals of earlier ranges, one row
    per range and key, are added. No task sees more than one range, however many
    rows a key or an instant has."""
    rows = ranged(df, [F.col(k).asc_nulls_first() for k in keys] + order, name)
    inside = Window.partitionBy("_part", *keys).orderBy("_spot").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_part", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = {m: F.lit(0).cast(dict(df.dtypes)[m]) for m in measures}
    base = totals.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         *[F.coalesce(F.sum(m).over(earlier), zero[m]).alias(f"_base_{m}") for m in measures])
    rows = rows.withColumns({f"_before_{m}": F.coalesce(F.sum(m).over(inside), zero[m]) for m in measures})
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(base if keys else F.broadcast(base), on)
    return joined.withColumns({f"_before_{m}": F.col(f"_before_{m}") + F.col(f"_base_{m}") for m in measures}).drop(
        "_p", "_part", "_spot", *[f"_k{i}" for i in range(len(keys))], *[f"_base_{m}" for m in measures])


def trailing_ranged(df: DataFrame, key: str, ts: str, row_id: str, measures: dict[str, tuple[Column, str]], spans_days: dict[str, int]) -> DataFrame:
    """As ``trailing_sums``, for keys of any number of rows, bursts of one
    instant and null keys. Rows without a time are each other's frame."""
    names, us = list(measures), epoch_us(ts)
    # own row before the probes of the same instant; without a time, edges come first of all
    points = [F.struct(us.alias("us"), F.lit(0).alias("after"), F.lit("row").alias("kind")), F.struct(us.alias("us"), F.lit(1).alias("after"), F.lit("now").alias("kind"))]
    points += [F.struct((us - F.lit(days * US_PER_DAY + 1)).alias("us"), F.when(us.isNull(), -1).otherwise(1).alias("after"), F.lit(suffix).alias("kind"))
               for suffix, days in spans_days.items()]
    rows = df.select(F.col(key).alias("_k"), F.col(row_id).alias("_id"), *[measures[m][0].cast(measures[m][1]).alias(m) for m in names], F.explode(F.array(*points)).alias("_p"))
    rows = rows.select("_k", "_id", "_p.*", *[F.when(F.col("_p.kind") == "row", F.col(m)).otherwise(F.lit(0).cast(measures[m][1])).alias(m) for m in names])
    summed = prefix_sums(rows, ["_k"], [F.col("us").asc_nulls_first(), F.col("after"), F.col("_id"), F.col("kind")], names, "points").where("kind <> 'row'")
    out = []
    for suffix in spans_days:
        for m in names:
            at = {kind: F.sum(F.when(F.col("kind") == kind, F.col(f"_before_{m}"))) for kind in ("now", suffix)}
            out.append((at["now"] - at[suffix]).alias(f"{m}_{suffix}"))
    return summed.groupBy(F.col("_id").alias(row_id)).agg(*out)


def running_ranged(df: DataFrame, key: str, order: list[str], row_id: str, measures: dict[str, tuple[Column, str]], include_current: bool) -> DataFrame:
    """As ``running_sums`` (0 where the frame is empty), for keys of any number
    of rows; with ``<measure>_all``, the key's total."""
    names = list(measures)
    rows = df.select(F.col(key).alias("_k"), F.col(row_id).alias("_id"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                     *[measures[m][0].cast(measures[m][1]).alias(m) for m in names])
    summed = prefix_sums(rows, ["_k"], [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))], names, "running")
    whole = rows.groupBy(F.col("_k").alias("_key")).agg(*[F.sum(m).alias(f"{m}_all") for m in names])
    here = {m: F.col(f"_before_{m}") + (F.col(m) if include_current else F.lit(0).cast(measures[m][1])) for m in names}
    return summed.join(whole, F.col("_k").eqNullSafe(F.col("_key"))).select(F.col("_id").alias(row_id), *[here[m].alias(m) for m in names], *[f"{m}_all" for m in names])
