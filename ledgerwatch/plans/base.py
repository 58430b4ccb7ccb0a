"""Base frames shared by the registered queries, derived from the driver's
tables (their work grows with the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FE
from ..session import materialize
from ..sources import tables as T


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return T.transactions(spark, sf)


def orders_tx(spark: SparkSession, sf: str) -> DataFrame:
    return T.orders_as_transactions(spark, sf)


def features(spark: SparkSession, sf: str) -> DataFrame:
    return FE.engineer_features(tx(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return FE.score(features(spark, sf))


def scored_table(spark: SparkSession, sf: str) -> DataFrame:
    """The scored transactions written once to the shared folder, for
    queries that read them more than once."""
    return materialize(scored(spark, sf), "scored")


def features_table(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(features(spark, sf), "features")


ORDERS_SQL = """orders_tx AS (
  select o_orderkey as transaction_id, o_custkey as customer_id, o_orderdate as transaction_timestamp,
         o_totalprice as transaction_amount,
         case when o_orderstatus = 'P' then null else o_orderpriority end as merchant_id
  from orders
)"""
