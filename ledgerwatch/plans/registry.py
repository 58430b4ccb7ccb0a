"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` plus,
where SQL can express it, the equivalent DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_to, sql_round_snapped

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql_round_snapped(sql)
        return fn
    return deco


def r6(c: Column | str) -> Column:
    """Doubles are compared at 6 decimal places in both engines."""
    return round_to(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column of ``df``."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            out.append(round_to(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def load_all() -> None:
    """Import every query module so that they register themselves."""
    from . import (  # noqa: F401
        q_analytics,
        q_drift,
        q_evaluation,
        q_explain,
        q_features,
        q_green,
        q_modelling,
        q_quality,
        q_scalars,
        q_sources,
        q_streaming,
    )
