"""Text and JSON column functions: labelled-section extraction, question
intent routing, scoring-payload parsing, money formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P
from .numeric import round_to


def labelled_section(context: Column, label: str) -> Column:
    """the text after ``<label>:\\n`` up to the section separator (or
    the end); null when the label is absent."""
    marker = f"{label}:\n"
    start = F.locate(marker, context)
    after = F.when(start > 0, context.substr(start + F.lit(len(marker)), F.length(context)))
    return F.when(after.isNotNull(), F.substring_index(after, P.CONTEXT_SECTION_SEPARATOR, 1))


def question_intent(question: Column) -> Column:
    """lower-case, then the first intent whose keyword occurs;
    ``general`` when none does."""
    q = F.lower(question)
    out = None
    for intent, words in P.QUESTION_INTENTS:
        cond = None
        for w in words:
            c = q.contains(w)
            cond = c if cond is None else cond | c
        out = F.when(cond, F.lit(intent)) if out is None else out.when(cond, F.lit(intent))
    return out.otherwise(F.lit("general"))


def payload_instances(payload: Column) -> Column:
    """``{"instances": [...]}`` or a single record → array of
    map<string, double>."""
    inst = F.get_json_object(payload, "$.instances")
    many = F.from_json(inst, "array<map<string,double>>")
    one = F.array(F.from_json(payload, "map<string,double>"))
    return F.when(inst.isNotNull(), many).otherwise(one)


def feature_or_zero(m: Column, name: str) -> Column:
    """F8: a feature from a parsed record, 0 when absent."""
    return F.coalesce(F.try_element_at(m, F.lit(name)), F.lit(0.0))


def money(v: Column) -> Column:
    """``$1.23M`` from a million, ``$12K`` from a thousand, else ``$v``
    (a whole amount without ``.0``)."""
    return (F.when(v >= 1_000_000, F.concat(F.lit("$"), F.format_string("%.2f", round_to(v / 1_000_000, 2)), F.lit("M")))
            .when(v >= 1_000, F.concat(F.lit("$"), round_to(v / 1_000, 0).cast("bigint").cast("string"), F.lit("K")))
            .otherwise(F.concat(F.lit("$"), F.regexp_replace(v.cast("string"), r"\.0$", ""))))


def percent(share: Column, digits: int = 2) -> Column:
    """a share as ``12.34%``."""
    return F.concat(F.format_string(f"%.{digits}f", round_to(share * 100, digits)), F.lit("%"))


def fixed(v: Column, digits: int = 3) -> Column:
    """fixed-point text."""
    return F.format_string(f"%.{digits}f", round_to(v, digits))
