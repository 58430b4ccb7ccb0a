"""Registered queries: attribution, explanations and the text/JSON helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import text as TXT
from ..operators import explain as X
from ..sources.tables import read_table
from . import base
from .registry import r6, register, rounded
from .sqlbase import with_features_and, with_scored, with_tx

COMPS = [("amount_deviation_ratio", "amount_deviation_ratio", 0.3),
         ("is_new_merchant", "cast(is_new_merchant as double)", 0.25),
         ("is_cross_border", "cast(is_cross_border as double)", 0.25),
         ("tx_count_7d", "case when tx_count_7d > 20 then 1.0 else 0.0 end", 0.2)]
MEANS = "means AS (select " + ", ".join(f"avg({e}) as m_{n}" for n, e, _ in COMPS) + " from features)"
ATTR_LONG = "attr AS (" + " union all ".join(
    f"select transaction_id, '{n}' as feature, cast({'tx_count_7d' if n == 'tx_count_7d' else e} as double) as feature_value, "
    f"({e} - m_{n}) * {w} as phi from features cross join means" for n, e, w in COMPS) + ")"


def _attr_sql(body: str) -> str:
    return with_features_and(MEANS + ",\n" + ATTR_LONG, body)


def attr(spark, sf):
    return X.rule_attribution(base.features_table(spark, sf))


@register("rule_attribution", _attr_sql(
    "select transaction_id, feature, round(feature_value, 6) as feature_value, round(phi, 6) as phi from attr"))
def rule_attribution(spark, sf):
    """M8: exact attribution of the linear rule score, long form."""
    return rounded(attr(spark, sf))


IMPORTANCE = "select feature, avg(abs(phi)) as importance from attr group by feature"


@register("attribution_importance", _attr_sql(
    f"select feature, round(importance, 6) as importance from ({IMPORTANCE})"))
def attribution_importance(spark, sf):
    """Mean |phi| per feature."""
    return rounded(X.attribution_importance(attr(spark, sf)))


STABILITY = "select 1.0 - avg(s) as explanation_stability from (select stddev_pop(abs(phi)) as s from attr group by feature)"


@register("explanation_stability", _attr_sql(
    f"select round(explanation_stability, 6) as explanation_stability from ({STABILITY})"))
def explanation_stability(spark, sf):
    """1 − mean over features of std_pop(|phi|)."""
    return rounded(X.explanation_stability(attr(spark, sf)))


@register("top_features", _attr_sql(
    "select feature, round(importance, 6) as importance, cast(row_number() over (order by importance desc, feature) as integer) "
    f"as rank from ({IMPORTANCE}) order by importance desc, feature limit 5"))
def top_features(spark, sf):
    """K2: top-5 features by importance."""
    return rounded(X.top_features(X.attribution_importance(attr(spark, sf))))


@register("xai_report", _attr_sql(
    f"select count(*) as n_features, (select feature from ({IMPORTANCE}) order by importance desc, feature desc limit 1) "
    f"as top_feature, round(max(importance), 6) as top_importance, (select round(explanation_stability, 6) from ({STABILITY})) "
    f"as explanation_stability, 'exact linear attribution' as methodology from ({IMPORTANCE})"))
def xai_report(spark, sf):
    """M9: the attribution report row."""
    return rounded(X.xai_report(attr(spark, sf)))


PAIR_SQL = "printf('%s=%.6f', feature, round(importance, 6))"


@register("importance_report", _attr_sql(
    f"select cast(count(*) as integer) as n_features, string_agg({PAIR_SQL}, '; ' order by feature) as feature_importance, "
    f"(select string_agg({PAIR_SQL}, '; ' order by importance desc, feature) from (select * from ({IMPORTANCE}) order by "
    f"importance desc, feature limit 5)) as top_features, (select round(explanation_stability, 6) from ({STABILITY})) as "
    f"explanation_stability, 'exact linear attribution' as methodology from ({IMPORTANCE})"))
def importance_report(spark, sf):
    """M9: the whole report: every feature's importance (shown by name) and
    the five largest in order."""
    shown = lambda p: F.format_string("%s=%.6f", p["feature"], r6(p["importance"]))
    r = X.importance_report(attr(spark, sf))
    return rounded(r.select(
        "n_features", F.array_join(F.transform(F.array_sort(F.map_entries("feature_importance")), lambda e: F.format_string("%s=%.6f", e["key"], r6(e["value"]))), "; ").alias("feature_importance"),
        F.array_join(F.transform("top_features", shown), "; ").alias("top_features"), "explanation_stability", "methodology"))


TOP3 = ("select transaction_id, cast(row_number() over (partition by transaction_id order by abs(phi) desc, feature) "
        "as integer) as rank, feature, phi from attr qualify rank <= 3")


@register("top_factors", _attr_sql(f"select transaction_id, rank, feature, round(phi, 6) as phi from ({TOP3})"))
def top_factors(spark, sf):
    """W8 + F16: the three largest factors of every transaction."""
    return rounded(X.top_factors(base.features(spark, sf)))


DESC_VALUES = ", ".join("('{}', '{}')".format(f, d.replace("'", "''")) for f, d in P.FEATURE_DESCRIPTIONS)


@register("feature_descriptions", _attr_sql(
    "select t.transaction_id, t.rank, t.feature, round(t.phi, 6) as phi, coalesce(d.description, 'Elevated ' || t.feature) "
    f"as description from ({TOP3}) t left join (values {DESC_VALUES}) d(feature, description) on d.feature = t.feature"))
def feature_descriptions(spark, sf):
    """Each top factor with its description (default ``Elevated <name>``)."""
    return rounded(X.with_descriptions(X.top_factors(base.features(spark, sf))))


def _pattern_sql(idx: int) -> str:
    parts = []
    for subs, pattern, action in P.EXECUTIVE_PATTERNS:
        cond = " or ".join(f"contains(lower(top_feature), '{s}')" for s in subs)
        val = (pattern, action)[idx].replace("'", "''")
        parts.append(f"when {cond} then '{val}'")
    dflt = P.EXECUTIVE_DEFAULT[idx].replace("'", "''")
    return "case " + " ".join(parts) + f" else '{dflt}' end"


RISK_WORD = "case when score > 0.7 then 'high' when score > 0.4 then 'moderate' else 'low' end"


@register("explain_text", with_scored(
    f"select s.transaction_id, t.feature as top_feature, {RISK_WORD} as risk_word, "
    "case when score > 0.8 then 'block' else 'review' end as action, "
    f"'Transaction ' || s.transaction_id || ' shows ' || {RISK_WORD} || ' fraud risk (' || "
    "cast(cast(round(score * 100) as bigint) as varchar) || '% confidence).' || chr(10) || chr(10) || 'Primary concern: ' || "
    f"{_pattern_sql(0).replace('top_feature', 't.feature')} || chr(10) || chr(10) || 'Recommendation: ' || "
    f"{_pattern_sql(1).replace('top_feature', 't.feature')} as explanation "
    f"from scored s join ({TOP3}) t on t.transaction_id = s.transaction_id and t.rank = 1 where s.score > 0.65",
    MEANS, ATTR_LONG))
def explain_text(spark, sf):
    """M10 + P10 + F15 (re-aimed): explanation text for every flagged transaction."""
    return X.explain_text(base.scored_table(spark, sf))


def _interpretation_sql() -> str:
    parts = []
    for subs, words in P.ANALYST_INTERPRETATIONS:
        cond = " or ".join(f"contains(lower(feature), '{s}')" for s in subs)
        parts.append(f"when {cond} then '{words.replace(chr(39), chr(39) * 2)}'")
    return "case " + " ".join(parts) + f" else '{P.ANALYST_INTERPRETATION_DEFAULT}' end"


@register("explain_analyst", with_scored(
    "select s.transaction_id, 'FRAUD ALERT: ' || s.transaction_id || chr(10) || 'Prediction confidence: ' || "
    "printf('%.2f', round(any_value(s.score) * 100, 2)) || '%' || chr(10) || chr(10) || 'Top contributors:' || chr(10) || "
    f"string_agg('  • ' || t.feature || ': ' || printf('%.3f', round(t.phi, 3)) || ' — ' || {_interpretation_sql().replace('(feature)', '(t.feature)')}, chr(10) order by t.rank) "
    "|| chr(10) || chr(10) || 'Decision threshold: 0.65' || chr(10) || chr(10) || 'Action: ' || "
    f"case when any_value(s.score) > 0.8 then '{P.ANALYST_ACTIONS[0]}' else '{P.ANALYST_ACTIONS[1]}' end as explanation "
    f"from scored s join ({TOP3}) t on t.transaction_id = s.transaction_id where s.score > 0.65 group by s.transaction_id",
    MEANS, ATTR_LONG))
def explain_analyst(spark, sf):
    """M10 + F14 + F15 for analysts: alert text of every flagged transaction."""
    return X.explain_analyst(base.scored_table(spark, sf))


# --- labelled JSON sections (F11) ---------------------------------------------

CONTEXT_SQL = (
    "select d, 'LOCAL DRIFT REPORT:' || chr(10) || '{\"day\": \"' || strftime(d, '%Y-%m-%d') || '\", \"n\": ' || n || "
    "', \"fraud\": ' || f || case when n % 5 = 0 then '' else '}' end || chr(10) || chr(10) || '---' || chr(10) || chr(10) "
    "|| 'LOCAL XAI REPORT:' || chr(10) || '{\"top_features\": []}' as context from (select cast(transaction_timestamp as date) "
    "as d, count(*) as n, sum(is_fraud) as f from transactions group by 1)")


def contexts(spark, sf):
    """Labelled context documents, one per event day; days whose count is a
    multiple of 5 carry a broken JSON section."""
    t = base.tx(spark, sf)
    d = t.groupBy(F.to_date("transaction_timestamp").alias("d")).agg(F.count(F.lit(1)).alias("n"),
                                                                     F.sum("is_fraud").alias("f"))
    js = F.concat(F.lit('{"day": "'), F.date_format("d", "yyyy-MM-dd"), F.lit('", "n": '), F.col("n").cast("string"),
                  F.lit(', "fraud": '), F.col("f").cast("string"), F.when(F.col("n") % 5 == 0, F.lit("")).otherwise(F.lit("}")))
    ctx = F.concat(F.lit("LOCAL DRIFT REPORT:\n"), js, F.lit(P.CONTEXT_SECTION_SEPARATOR),
                   F.lit('LOCAL XAI REPORT:\n{"top_features": []}'))
    return d.select("d", ctx.alias("context"))


@register("labelled_json_section", with_tx(
    "select d as report_day, case when json_valid(b) then cast(json_extract_string(b, '$.n') as bigint) end as n, "
    "case when json_valid(b) then cast(json_extract_string(b, '$.fraud') as bigint) end as fraud, "
    "case when json_valid(b) then json_extract_string(b, '$.day') end as day_text from ("
    "select d, split_part(substr(context, strpos(context, 'LOCAL DRIFT REPORT:' || chr(10)) + 20), "
    "chr(10) || chr(10) || '---' || chr(10) || chr(10), 1) as b from (" + CONTEXT_SQL + "))"))
def labelled_json_section(spark, sf):
    """parse the JSON after ``LOCAL DRIFT REPORT:``; broken JSON → nulls."""
    c = contexts(spark, sf)
    block = TXT.labelled_section(F.col("context"), "LOCAL DRIFT REPORT")
    parsed = F.from_json(block, "day string, n bigint, fraud bigint", {"mode": "PERMISSIVE"})
    return c.select(F.col("d").alias("report_day"), parsed.alias("j")).select(
        "report_day", F.col("j.n").alias("n"), F.col("j.fraud").alias("fraud"), F.col("j.day").alias("day_text"))


# --- question intent (F12) ----------------------------------------------------

def _intent_sql() -> str:
    parts = []
    for intent, words in P.QUESTION_INTENTS:
        cond = " or ".join(f"contains(lower(q), '{w}')" for w in words)
        parts.append(f"when {cond} then '{intent}'")
    return "case " + " ".join(parts) + " else 'general' end"


@register("question_intent", f"select conv_id, turn, {_intent_sql()} as intent from (select conv_id, turn, text as q from conversations)")
def question_intent(spark, sf):
    """route every conversation text to the first matching intent
    (null: general)."""
    c = read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", TXT.question_intent(F.col("text")).alias("intent"))


# --- scoring payloads (S16, F8) ----------------------------------------------

PAYLOAD_FIELDS = ["transaction_amount", "tx_count_7d", "hour_of_day", "is_weekend", "is_cross_border"]


def payloads(spark, sf):
    """One JSON request per transaction, integer-valued features; every third
    leaves ``is_cross_border`` out and every tenth is a bare record."""
    t = base.tx(spark, sf)
    rec = F.concat(
        F.lit('{"transaction_amount": '), F.floor("transaction_amount").cast("string"),
        F.lit(', "tx_count_7d": '), (F.col("transaction_id") % 30).cast("string"),
        F.lit(', "hour_of_day": '), F.hour("transaction_timestamp").cast("string"),
        F.lit(', "is_weekend": '), (F.col("transaction_id") % 2).cast("string"),
        F.when(F.col("transaction_id") % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit(', "is_cross_border": '), (F.col("transaction_id") % 5 == 0).cast("int").cast("string"))),
        F.lit("}"))
    body = F.when(F.col("transaction_id") % 10 == 0, rec).otherwise(F.concat(F.lit('{"instances": ['), rec, F.lit("]}")))
    return t.select("transaction_id", body.alias("payload"))


@register("score_payload_parse", with_tx(
    "select transaction_id, " + ", ".join(
        f"coalesce(cast(coalesce(json_extract_string(payload, '$.instances[0].{f}'), json_extract_string(payload, '$.{f}')) "
        f"as double), 0.0) as {f}" for f in PAYLOAD_FIELDS + ["amount_deviation_ratio"]) + " from ("
    "select transaction_id, case when transaction_id % 10 = 0 then r else '{\"instances\": [' || r || ']}' end as payload from ("
    "select transaction_id, '{\"transaction_amount\": ' || cast(floor(transaction_amount) as bigint) || ', \"tx_count_7d\": ' || "
    "(transaction_id % 30) || ', \"hour_of_day\": ' || hour(transaction_timestamp) || ', \"is_weekend\": ' || "
    "(transaction_id % 2) || case when transaction_id % 3 = 0 then '' else ', \"is_cross_border\": ' || "
    "cast(transaction_id % 5 = 0 as integer) end || '}' as r from transactions))"))
def score_payload_parse(spark, sf):
    """S16 + F8: parse requests (list or bare record), absent features → 0."""
    p = payloads(spark, sf)
    rows = p.select("transaction_id", F.explode(TXT.payload_instances(F.col("payload"))).alias("m"))
    return rows.select("transaction_id", *[TXT.feature_or_zero(F.col("m"), f).alias(f)
                                           for f in PAYLOAD_FIELDS + ["amount_deviation_ratio"]])


# --- money formatting (F14) -----------------------------------------------------

MONEY_SQL = ("case when v >= 1000000 then '$' || printf('%.2f', round(v / 1000000, 2)) || 'M' "
             "when v >= 1000 then '$' || cast(cast(round(v / 1000) as bigint) as varchar) || 'K' "
             "else '$' || regexp_replace(cast(v as varchar), '\\.0$', '') end")


@register("money_format", with_tx(
    f"select customer_id, round(v, 6) as total_amount, {MONEY_SQL} as formatted from "
    "(select customer_id, sum(cast(transaction_amount as decimal(38,2))) * 100 as v0, "
    "cast(sum(cast(transaction_amount as decimal(38,2))) * 100 as double) as v from transactions group by 1)"))
def money_format(spark, sf):
    """dollar formatting with M / K suffixes of each customer's total
    (×100 so all three forms occur)."""
    t = base.tx(spark, sf)
    g = t.groupBy("customer_id").agg(
        (F.sum(F.col("transaction_amount").cast("decimal(38,2)")) * 100).cast("double").alias("v"))
    return rounded(g.select("customer_id", F.col("v").alias("total_amount"), TXT.money(F.col("v")).alias("formatted")))
