r"""Conversations as training text, with relational operations only.

Template (fixed)::

    <turn ROLE>\nTEXT</turn>\n

Adjacent turns of one role share a block, their texts set apart by
``<part/>``. ROLE is URL-encoded. Inside a text every ``<`` that begins a
control string (``<turn ``, ``</turn>``, ``<part/>``, with any number of
backslashes after the ``<``) gets one more backslash after it, and reading
takes one away; so no text can look like a mark, and every text comes back
unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"(turn |/turn>|part/>)"
CLOSE, PART = "</turn>\n", "<part/>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)" + CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)" + CONTROL, r"<$1$2")


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text):
    conv_id, formatted, loss_spans (array of start and length, in code points
    of ``formatted``, one per text of a loss role, in order).

    Turn structs are collected and sorted by turn (ties: by role, then text;
    a null turn first), adjacent same-role turns merge into one block by an
    array aggregation, and blocks are concatenated. Null text and null role
    count as empty. Rows without conv_id are one conversation of their own
    (null). Repeated rows are repeated turns. Extra columns are ignored, an
    empty table gives an empty result. A row of the result is one conversation,
    which is what bounds the rows brought together."""
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def merge(blocks: Column, t: Column) -> Column:
        last = F.element_at(blocks, -1)
        body = escape(t["text"])
        fresh = F.struct(t["role"].alias("role"), F.array(body).alias("parts"))
        grown = F.struct(last["role"].alias("role"), F.concat(last["parts"], F.array(body)).alias("parts"))
        same = (F.size(blocks) > 0) & (last["role"] == t["role"])
        return F.when(same, F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(grown))).otherwise(F.concat(blocks, F.array(fresh)))

    empty = F.array().cast("array<struct<role:string,parts:array<string>>>")
    merged = sorted_turns.select("conv_id", F.aggregate("turns", empty, merge).alias("blocks"))

    def head(b: Column) -> Column:
        return F.concat(F.lit("<turn "), F.url_encode(b["role"]), F.lit(">\n"))

    text = F.array_join(F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["parts"], PART), F.lit(CLOSE))), "")
    # every part with the number of characters before and after it that are marks
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["parts"], lambda p, i: F.struct(
        F.when(i == 0, F.length(head(b))).otherwise(F.lit(0)).alias("before"),
        F.length(p).alias("len"),
        F.when(i == F.size(b["parts"]) - 1, F.lit(len(CLOSE))).otherwise(F.lit(len(PART))).alias("after"),
        b["role"].isin(*loss_roles).alias("loss")))))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,len:int>>").alias("spans"))

    def place(acc: Column, p: Column) -> Column:
        at = acc["at"] + p["before"]
        span = F.array(F.struct(at.alias("start"), p["len"].alias("len")))
        return F.struct((at + p["len"] + p["after"]).alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return merged.select("conv_id", text.alias("formatted"), F.aggregate(pieces, start, place, lambda acc: acc["spans"]).alias("loss_spans"))


def read_conversations(formatted: DataFrame) -> DataFrame:
    """The inverse: conv_id, turns (array of role and text, one per original
    turn, read from the marks) and loss_text (the unescaped text under the
    loss mask, nothing between), with ``formatted``."""
    blocks = F.filter(F.split("formatted", "</turn>\n", -1), lambda b: b != "")
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.regexp_replace(b, r"^<turn [^>]*>\n", ""), PART, -1),
        lambda p: F.struct(F.url_decode(F.regexp_extract(b, r"^<turn ([^>]*)>\n", 1)).alias("role"), unescape(p).alias("text")))))
    under = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["len"]))), "")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), under.alias("loss_text"))


ORACLE = r"""with c as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from c),
m as (
  select *, lag(role) over w as before, length(regexp_replace(text, '<(\\*)(turn |/turn>|part/>)', '<\\\1\2', 'g')) as chars
  from t window w as (partition by conv_id order by turn nulls first, role, text))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars + case when before = role then 7 else 16 + length(role) end) as bigint) as formatted_chars
from m group by conv_id"""
