"""Data-quality checks and the data-quality gate. Every check set runs as a
single aggregation pass over the table, then is reshaped to long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..sources import versions as V


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stack_long(df: DataFrame, keep: list[str], pairs: list[tuple[str, str]], name_col: str, value_col: str) -> DataFrame:
    """Wide one-row aggregates → long form with ``stack``. ``pairs`` are
    (label, column)."""
    args = ", ".join(f"{_sql_str(lbl)}, `{col}`" for lbl, col in pairs)
    return df.selectExpr(*keep, f"stack({len(pairs)}, {args}) as ({name_col}, {value_col})")


def column_completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, position, non_null_share) for every column, one pass."""
    cols = columns or df.columns
    total = F.count(F.lit(1))
    wide = df.agg(*[(F.count(F.col(c)) / total).alias(f"_s{i}") for i, c in enumerate(cols)])
    longf = stack_long(wide, [], [(c, f"_s{i}") for i, c in enumerate(cols)], "column_name", "non_null_share")
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i + 1))])
    return longf.withColumn("position", pos[F.col("column_name")])


def completeness_expr(columns: list[str]) -> Column:
    """Mean over columns of the non-null share (pandas ``notna().mean().mean()``)."""
    total = F.count(F.lit(1))
    acc = None
    for c in columns:
        term = F.count(F.col(c)) / total
        acc = term if acc is None else acc + term
    return acc / F.lit(float(len(columns)))


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A5: one row ``completeness``."""
    return df.agg(completeness_expr(columns or df.columns).alias("completeness"))


def label_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """A2: rows per label value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def imbalance_expr(label: str = "is_fraud") -> tuple[Column, Column, Column]:
    """Legit count (1 when absent), fraud count, ratio legit / max(fraud, 1)."""
    n0 = F.count_if(F.col(label) == 0)
    n1 = F.count_if(F.col(label) == 1)
    legit = F.when(n0 == 0, F.lit(1)).otherwise(n0)
    fraud = F.greatest(F.when(n1 == 0, F.lit(1)).otherwise(n1), F.lit(1))
    return n0, n1, legit.cast("double") / fraud


def class_imbalance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    n0, n1, ratio = imbalance_expr(label)
    return df.agg(n0.alias("n_legit"), n1.alias("n_fraud"), ratio.alias("imbalance_ratio"))


def amount_stats(df: DataFrame, by: str | None = "cohort", amount: str = "transaction_amount") -> DataFrame:
    """A3: mean and sample standard deviation of the amount."""
    aggs = [F.count(F.col(amount)).alias("n"), F.avg(amount).alias("mean_amount"),
            F.stddev_samp(amount).alias("std_amount")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def violating_rows(df: DataFrame) -> DataFrame:
    """Rows breaking a row-level rule, with one flag per rule."""
    amt, risk = F.col("transaction_amount"), F.col("rule_based_risk")
    flags = {
        "amount_not_positive": amt <= 0,
        "amount_over_max": amt > F.lit(P.AMOUNT_MAX),
        "risk_out_of_range": (risk < F.lit(P.RISK_MIN)) | (risk > F.lit(P.RISK_MAX)),
        "has_required_null": F.col("customer_id").isNull() | amt.isNull() | F.col("is_fraud").isNull(),
    }
    out = df.select("transaction_id", *[F.coalesce(c, F.lit(False)).cast("int").alias(n) for n, c in flags.items()])
    return out.where(" + ".join(flags) + " > 0")


def expectation_suite(df: DataFrame) -> DataFrame:
    """V2 + U2: the expectation list as rows (check_id, expectation,
    column_name, success, unexpected_count, observed_value), from one pass."""
    present = set(df.columns)
    amt, risk = F.col("transaction_amount"), F.col("rule_based_risk")
    wide = df.agg(
        F.count_if((amt < P.AMOUNT_MIN) | (amt > P.AMOUNT_MAX)).alias("amt_bad"),
        F.count_if((risk < P.RISK_MIN) | (risk > P.RISK_MAX)).alias("risk_bad"),
        F.avg("is_fraud").alias("fraud_rate"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in P.NOT_NULL_COLUMNS],
    )
    rows = []
    i = 0
    for c in P.SUITE_EXISTENCE_COLUMNS:
        i += 1
        rows.append(F.struct(F.lit(i).alias("check_id"), F.lit("expect_column_to_exist").alias("expectation"),
                             F.lit(c).alias("column_name"), F.lit(c in present).alias("success"),
                             F.lit(0).cast("bigint").alias("unexpected_count"),
                             F.lit(None).cast("double").alias("observed_value")))
    for c, bad in [("transaction_amount", "amt_bad"), ("rule_based_risk", "risk_bad")]:
        i += 1
        rows.append(F.struct(F.lit(i).alias("check_id"), F.lit("expect_column_values_to_be_between").alias("expectation"),
                             F.lit(c).alias("column_name"), (F.col(bad) == 0).alias("success"),
                             F.col(bad).cast("bigint").alias("unexpected_count"),
                             F.lit(None).cast("double").alias("observed_value")))
    i += 1
    rate = F.col("fraud_rate")
    rows.append(F.struct(F.lit(i).alias("check_id"), F.lit("expect_column_mean_to_be_between").alias("expectation"),
                         F.lit("is_fraud").alias("column_name"),
                         ((rate >= P.FRAUD_RATE_MIN) & (rate <= P.FRAUD_RATE_MAX)).alias("success"),
                         F.lit(None).cast("bigint").alias("unexpected_count"), rate.alias("observed_value")))
    for c in P.NOT_NULL_COLUMNS:
        i += 1
        rows.append(F.struct(F.lit(i).alias("check_id"), F.lit("expect_column_values_to_not_be_null").alias("expectation"),
                             F.lit(c).alias("column_name"), (F.col(f"null_{c}") == 0).alias("success"),
                             F.col(f"null_{c}").cast("bigint").alias("unexpected_count"),
                             F.lit(None).cast("double").alias("observed_value")))
    return wide.select(F.inline(F.array(*rows)))


def local_validation(df: DataFrame) -> DataFrame:
    """V3: one row (passed, failures) with the failure messages in check order."""
    present = set(df.columns)
    amt, risk = F.col("transaction_amount"), F.col("rule_based_risk")
    wide = df.agg(
        F.count_if(amt <= 0).alias("n_nonpos"), F.max(amt).alias("max_amt"),
        F.min(risk).alias("min_risk"), F.max(risk).alias("max_risk"), F.avg("is_fraud").alias("rate"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in P.NOT_NULL_COLUMNS],
    )
    msgs = [F.lit(f"Missing column: {c}") for c in P.LOCAL_REQUIRED_COLUMNS if c not in present]
    msgs += [
        F.when(F.col("n_nonpos") > 0, F.lit("transaction_amount must be positive")),
        F.when(F.col("max_amt") > P.AMOUNT_MAX, F.lit("transaction_amount exceeds max")),
        F.when((F.col("min_risk") < 0) | (F.col("max_risk") > 1), F.lit("rule_based_risk out of [0,1]")),
        F.when((F.col("rate") < P.FRAUD_RATE_MIN) | (F.col("rate") > P.FRAUD_RATE_MAX),
               F.format_string("is_fraud rate %.3f outside [0.5%%, 5%%]", F.col("rate"))),
        *[F.when(F.col(f"null_{c}") > 0, F.lit(f"Nulls in {c}")) for c in P.NOT_NULL_COLUMNS],
    ]
    failures = F.filter(F.array(*msgs), lambda x: x.isNotNull())
    return wide.select((F.size(failures) == 0).alias("passed"), failures.alias("failures"))


def mean_shift(df: DataFrame, amount: str = "transaction_amount", cohort: str = "cohort",
               baseline: str = "baseline", current: str = "current") -> DataFrame:
    """V4 + J5: current mean against the stored baseline mean."""
    b = df.where(F.col(cohort) == baseline).agg(F.avg(amount).alias("baseline_mean"),
                                               F.stddev_samp(amount).alias("baseline_std"))
    c = df.where(F.col(cohort) == current).agg(F.avg(amount).alias("current_mean"))
    shift = F.abs(F.col("current_mean") - F.col("baseline_mean")) / F.col("baseline_mean")
    return b.crossJoin(c).select("baseline_mean", "baseline_std", "current_mean", shift.alias("shift"),
                                 (shift > P.MEAN_SHIFT_LIMIT).alias("warning"))


def mean_shift_against_stored(df: DataFrame, store: str, amount: str = "transaction_amount") -> DataFrame:
    """V4 + J5: the mean amount against the statistics kept in ``store``: a
    first run saves its own (no shift then), later runs compare with them. No
    shift either where a mean is missing or the stored one is 0."""
    stats = df.agg(F.avg(amount).alias("mean"), F.stddev_samp(amount).alias("std"))
    base, created = V.read_or_create(df.sparkSession, store, lambda: stats)
    both = base.select(F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std")).crossJoin(stats.select(F.col("mean").alias("current_mean")))
    shift = F.when(~F.lit(created), F.try_divide(F.abs(F.col("current_mean") - F.col("baseline_mean")), F.col("baseline_mean")))
    return both.select(F.lit(created).alias("created"), "baseline_mean", "baseline_std", "current_mean", shift.alias("shift"),
                       F.coalesce(shift > P.MEAN_SHIFT_LIMIT, F.lit(False)).alias("warning"))


def required_columns(df: DataFrame) -> DataFrame:
    """V1: for each policy's required column: present, and its non-null count
    over the whole table (0 when absent)."""
    policies = [("feature_schema", P.FEATURE_COLUMNS), ("governance", P.GOVERNANCE_REQUIRED_FEATURES),
                ("local", P.LOCAL_REQUIRED_COLUMNS)]
    needed = sorted({c for _, cols in policies for c in cols if c in df.columns})
    counts = df.agg(*[F.count(F.col(c)).alias(f"_n_{c}") for c in needed])
    rows = []
    for pol, cols in policies:
        for i, c in enumerate(cols):
            ok = c in df.columns
            rows.append(F.struct(F.lit(pol).alias("policy"), F.lit(i + 1).alias("position"),
                                 F.lit(c).alias("column_name"), F.lit(ok).alias("present"),
                                 (F.col(f"_n_{c}") if ok else F.lit(0)).cast("bigint").alias("non_null_count")))
    return counts.select(F.inline(F.array(*rows)))


def data_quality_gate(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """G1: one audit row (passed, completeness, violations, records_checked)."""
    missing = [c for c in P.GOVERNANCE_REQUIRED_FEATURES if c not in df.columns]
    has_label = label in df.columns
    aggs = [completeness_expr(df.columns).alias("completeness"), F.count(F.lit(1)).alias("records_checked")]
    if has_label:
        aggs.append(imbalance_expr(label)[2].alias("imbalance_ratio"))
    wide = df.agg(*aggs)
    limit = P.MAX_CLASS_IMBALANCE_RATIO
    limit_txt = str(int(limit)) if float(limit).is_integer() else str(limit)
    msgs = [
        F.when(F.col("completeness") < P.MIN_DATA_COMPLETENESS,
               F.format_string(f"Data completeness %.2f%% below threshold {P.MIN_DATA_COMPLETENESS * 100:.2f}%%",
                               F.col("completeness") * 100)),
    ]
    if missing:
        msgs.append(F.lit(f"Missing required features: {missing!r}"))
    if has_label:
        msgs.append(F.when(F.col("imbalance_ratio") > limit,
                           F.format_string(f"Class imbalance ratio %.1fx exceeds policy {limit_txt}x",
                                           F.col("imbalance_ratio"))))
    violations = F.filter(F.array(*msgs), lambda x: x.isNotNull())
    return wide.select(F.lit("data_quality").alias("policy"), (F.size(violations) == 0).alias("passed"),
                       "completeness", violations.alias("violations"), "records_checked")
