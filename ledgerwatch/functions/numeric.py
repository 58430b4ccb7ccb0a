"""Numeric helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = "decimal(38,10)"


def round_to(c: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, half away from zero, after first
    snapping it to 10 decimals.

    Aggregates summed in a different order differ in the last bits; a
    value whose exact result sits on a rounding tie (common with two-decimal
    amounts and power-of-two counts) would round either way. Snapping to a
    decimal first makes such values round the same way everywhere. NaN,
    infinities and values out of decimal range pass through unchanged.
    """
    return F.coalesce(F.round(c.try_cast(SNAP), digits).cast("double"), c.cast("double"))


def sql_round_snapped(sql: str) -> str:
    """Rewrite every ``round(expr[, d])`` of a SQL string into the same
    snapped rounding as :func:`round_to`."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        # find the matching parenthesis and the last top-level comma
        depth, k, comma, quote = 0, j + 5, -1, False
        while k < len(sql):
            ch = sql[k]
            if ch == "'":
                quote = not quote
            elif not quote:
                if ch == "(":
                    depth += 1
                elif ch == ")":
                    depth -= 1
                    if depth == 0:
                        break
                elif ch == "," and depth == 1:
                    comma = k
            k += 1
        inner = sql[j + 6:k]
        if comma >= 0:
            expr, digits = sql[j + 6:comma], sql[comma + 1:k].strip()
        else:
            expr, digits = inner, "0"
        expr = sql_round_snapped(expr)
        out.append(sql[i:j])
        out.append(f"coalesce(cast(round(try_cast(({expr}) as {SNAP}), {digits}) as double), cast(({expr}) as double))")
        i = k + 1
