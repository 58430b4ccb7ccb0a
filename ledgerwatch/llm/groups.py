"""Rows joined with their groups, where one group may hold a third of all rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-3        # a group with at least this share of all grouped rows is hot; at most 1 / share of them exist


def with_groups(rows: DataFrame, groups: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """The rows of ``rows`` that are in one of ``groups``, with its columns.
    ``groups`` is a written table of one row per group, with the number of its
    rows in ``copies``.

    Groups of at least two copies and of at least ``share`` of all copies are at
    most 1 / share many, however large the table: they are broadcast, so their
    rows get them where they lie. No other group is large, so the rest takes the
    ordinary join."""
    copies = groups.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") >= max(2, math.ceil(copies * share))
    heavy, light = groups.where(hot), groups.where(~hot)
    common = rows.join(F.broadcast(heavy), on)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light, on)
    return rest.unionByName(common)
