"""Attribution and explanations.

The rule score is linear, so its exact attribution is
``phi_f = w_f · (x_f − mean(x_f))`` with base value ``Σ w_f · mean(x_f)``;
``Σ phi + base`` gives back the score. Per-row work (top factors, texts)
stays inside the row — arrays sorted per row, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import params as P
from ..functions.numeric import round_to
from ..functions.text import fixed, percent

# Rule components: (feature name, value column expression, weight).
def rule_components() -> list[tuple[str, Column, float]]:
    w = P.RISK_WEIGHTS_NOTEBOOK
    return [
        ("amount_deviation_ratio", F.col("amount_deviation_ratio"), w[0]),
        ("is_new_merchant", F.col("is_new_merchant").cast("double"), w[1]),
        ("is_cross_border", F.col("is_cross_border").cast("double"), w[2]),
        ("tx_count_7d", F.when(F.col("tx_count_7d") > P.VELOCITY_LIMIT_7D, 1.0).otherwise(0.0), w[3]),
    ]


def rule_attribution_wide(features: DataFrame) -> DataFrame:
    """Adds ``phi_<feature>`` columns and ``base_value`` to every row. The
    population means are a one-row aggregate broadcast to all tasks."""
    comps = rule_components()
    x = features.select("*", *[c.alias(f"_x_{n}") for n, c, _ in comps])
    means = x.agg(*[F.avg(f"_x_{n}").alias(f"_m_{n}") for n, _, _ in comps])
    base = None
    for n, _, w in comps:
        t = F.col(f"_m_{n}") * w
        base = t if base is None else base + t
    j = x.crossJoin(F.broadcast(means))
    return j.select(
        *features.columns,
        *[((F.col(f"_x_{n}") - F.col(f"_m_{n}")) * w).alias(f"phi_{n}") for n, _, w in comps],
        base.alias("base_value"))


def rule_attribution(features: DataFrame) -> DataFrame:
    """M8 long form: (transaction_id, feature, feature_value, phi)."""
    comps = rule_components()
    wide = rule_attribution_wide(features.select("transaction_id", *[c.alias(n) if n != "tx_count_7d" else F.col("tx_count_7d")
                                                                     for n, c, _ in comps]))
    items = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("feature_value"),
                               F.col(f"phi_{n}").alias("phi")) for n, _, _ in comps])
    return wide.select("transaction_id", F.inline(items))


def attribution_importance(attr: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    return attr.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))


def explanation_stability(attr: DataFrame) -> DataFrame:
    """1 − mean over features of the population std of |phi|."""
    per = attr.groupBy("feature").agg(F.stddev_pop(F.abs("phi")).alias("_s"))
    return per.agg((F.lit(1.0) - F.avg("_s")).alias("explanation_stability"))


def top_features(importance: DataFrame, n: int = 5) -> DataFrame:
    """K2: the ``n`` most important features with their rank."""
    top = importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)
    # At most n rows: the ranking window runs over the top-k result only.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("importance").desc(), F.col("feature"))))


def xai_report(attr: DataFrame) -> DataFrame:
    """M9: one report row — feature count, top feature and its importance,
    explanation stability."""
    imp = attribution_importance(attr)
    top = imp.agg(F.max(F.struct(F.col("importance"), F.col("feature"))).alias("_t"),
                  F.count(F.lit(1)).alias("n_features"))
    return top.crossJoin(explanation_stability(attr)).select(
        "n_features", F.col("_t.feature").alias("top_feature"), F.col("_t.importance").alias("top_importance"),
        "explanation_stability", F.lit("exact linear attribution").alias("methodology"))


def importance_report(attr: DataFrame, n: int = 5) -> DataFrame:
    """M9 in full: one report row with the importance of every feature
    (``feature_importance``, a map), the ``n`` largest in order
    (``top_features``, structs; ties by name), explanation stability and
    methodology. Built from one row per feature; with no rows the map is empty."""
    pairs = F.collect_list(F.struct("feature", "importance"))       # one per feature
    by_size = F.transform(F.array_sort(F.transform("_pairs", lambda p: F.struct((-p["importance"]).alias("k"), p["feature"].alias("feature")))),
                          lambda p: F.struct(p["feature"].alias("feature"), (-p["k"]).alias("importance")))
    return attribution_importance(attr).agg(pairs.alias("_pairs")).crossJoin(explanation_stability(attr)).select(
        F.size("_pairs").alias("n_features"), F.map_from_entries("_pairs").alias("feature_importance"),
        F.slice(by_size, 1, n).alias("top_features"), "explanation_stability", F.lit("exact linear attribution").alias("methodology"))


def _sorted_factors() -> Column:
    """The factors of a row of ``rule_attribution_wide``, largest |phi| first,
    ties by name."""
    return F.array_sort(F.array(*[F.struct((-F.abs(F.col(f"phi_{n}"))).alias("k"), F.lit(n).alias("feature"),
                                           F.col(f"phi_{n}").alias("phi")) for n, _, _ in rule_components()]))


def top_factors(features: DataFrame, k: int = 3) -> DataFrame:
    """W8 + F16: per transaction, the ``k`` largest |phi| factors (ties by
    name), sorted inside each row; long form (transaction_id, rank,
    feature, phi)."""
    wide = rule_attribution_wide(features)
    top = F.slice(_sorted_factors(), 1, k)
    return wide.select("transaction_id", F.posexplode(top).alias("pos", "f")).select(
        "transaction_id", (F.col("pos") + 1).alias("rank"), F.col("f.feature").alias("feature"),
        F.col("f.phi").alias("phi"))


def descriptions_table(spark) -> DataFrame:
    """The feature → description lookup (fixed, eight rows)."""
    return spark.createDataFrame(P.FEATURE_DESCRIPTIONS, "feature string, description string")


def with_descriptions(factors: DataFrame) -> DataFrame:
    """Description per factor, default ``Elevated <feature>``; the
    lookup is a fixed eight-row table, broadcast."""
    d = F.broadcast(descriptions_table(factors.sparkSession))
    return factors.join(d, "feature", "left").withColumn(
        "description", F.coalesce(F.col("description"), F.concat(F.lit("Elevated "), F.col("feature"))))


def risk_word(p: Column) -> Column:
    """P10: high / moderate / low."""
    return F.when(p > P.EXPLAIN_HIGH, "high").when(p > P.EXPLAIN_MODERATE, "moderate").otherwise("low")


def _pattern(feature: Column, idx: int) -> Column:
    out = None
    for subs, pattern, action in P.EXECUTIVE_PATTERNS:
        cond = None
        for s in subs:
            c = F.lower(feature).contains(s)
            cond = c if cond is None else cond | c
        val = F.lit((pattern, action)[idx])
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.lit(P.EXECUTIVE_DEFAULT[idx]))


def _flagged(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows above the threshold with ``_top``: their factors, largest |phi|
    first. Sorted inside the row, so rows need no unique id and no shuffle."""
    return rule_attribution_wide(scored).where(F.col("score") > threshold).withColumn("_top", _sorted_factors())


def _interpretation(feature: Column) -> Column:
    out = None
    for subs, words in P.ANALYST_INTERPRETATIONS:
        cond = None
        for s in subs:
            c = F.lower(feature).contains(s)
            cond = c if cond is None else cond | c
        out = F.when(cond, F.lit(words)) if out is None else out.when(cond, F.lit(words))
    return out.otherwise(F.lit(P.ANALYST_INTERPRETATION_DEFAULT))


def explain_analyst(scored: DataFrame, threshold: float = P.DECISION_THRESHOLD, k: int = 3) -> DataFrame:
    """M10 + F15 for analysts: an alert for every flagged transaction with the
    confidence to two places, the ``k`` largest factors with their
    interpretation, the threshold and the action."""
    lines = F.transform(F.slice("_top", 1, k), lambda f: F.concat(
        F.lit("  • "), f["feature"], F.lit(": "), fixed(f["phi"], 3), F.lit(" — "), _interpretation(f["feature"])))
    action = F.when(F.col("score") > P.EXPLAIN_BLOCK, P.ANALYST_ACTIONS[0]).otherwise(P.ANALYST_ACTIONS[1])
    text = F.concat(
        F.lit("FRAUD ALERT: "), F.col("transaction_id").cast("string"), F.lit("\nPrediction confidence: "), percent(F.col("score")),
        F.lit("\n\nTop contributors:\n"), F.array_join(lines, "\n"), F.lit(f"\n\nDecision threshold: {threshold}\n\nAction: "), action)
    return _flagged(scored, threshold).select("transaction_id", text.alias("explanation"))


def explain_text(scored: DataFrame, threshold: float = P.DECISION_THRESHOLD) -> DataFrame:
    """M10 + F15 (re-aimed): an executive explanation for every flagged
    transaction, with the pattern chosen by its top factor."""
    j = _flagged(scored, threshold).select("transaction_id", "score", F.col("_top")[0]["feature"].alias("top_feature"))
    pct = round_to(F.col("score") * 100, 0).cast("bigint")
    text = F.concat(
        F.lit("Transaction "), F.col("transaction_id").cast("string"), F.lit(" shows "), risk_word(F.col("score")),
        F.lit(" fraud risk ("), pct.cast("string"), F.lit("% confidence).\n\nPrimary concern: "),
        _pattern(F.col("top_feature"), 0), F.lit("\n\nRecommendation: "), _pattern(F.col("top_feature"), 1))
    action = F.when(F.col("score") > P.EXPLAIN_BLOCK, "block").otherwise("review")
    return j.select("transaction_id", "top_feature", risk_word(F.col("score")).alias("risk_word"),
                    action.alias("action"), text.alias("explanation"))
