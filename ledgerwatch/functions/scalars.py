"""Scalar column functions: identifier formatting, time formats and shifts,
clipping, map extremes, JSON and prefix handling. All are built-in
expressions (codegen'd, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, c: Column, width: int) -> Column:
    """``prefix`` + zero-padded number (``C00042``, ``TX-0000042``); a
    wider number is kept whole."""
    return F.format_string(f"{prefix}%0{width}d", c.cast("bigint"))


# display formats (Spark datetime patterns).
TIME_FORMATS = {
    "month_abbr": "MMM",
    "hour_label": "HH:00",
    "clock": "HH:mm:ss",
    "iso": "yyyy-MM-dd'T'HH:mm:ss",
    "file_stamp": "yyyyMMdd_HHmmss",
}


def time_formats(ts: Column) -> list[Column]:
    return [F.date_format(ts, pat).alias(name) for name, pat in TIME_FORMATS.items()]


def shift(ts: Column, days: int = 0, hours: int = 0, seconds: int = 0) -> Column:
    """subtract days / hours / seconds."""
    return ts - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days), F.lit(hours), F.lit(0), F.lit(seconds))


def clip(c: Column, lo: float, hi: float) -> Column:
    """``least(greatest(c, lo), hi)`` with nulls kept null."""
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def map_max(m: Column) -> Column:
    """largest value of a map."""
    return F.array_max(F.map_values(m))


def map_min(m: Column) -> Column:
    return F.array_min(F.map_values(m))


def strip_prefix(c: Column, prefix: str) -> Column:
    """remove a leading prefix (only at the start)."""
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def short_id(c: Column, n: int = 8) -> Column:
    """the first ``n`` characters."""
    return F.substring(c, 1, n)
