"""A training corpus from raw documents: language identification, exact and
near deduplication, mixing sources, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import bpe, exact_dedup, langid, minhash, mixing
from ledgerwatch.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are of no language rather than another go; a
    missing lang is filled."""
    return langid.identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts stays."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles,
    similarity of 0.8 or more) stays. Rows get numbers of their own, written so
    that they hold, and are compared and removed by those: rows that share a
    doc_id, or have none, are documents like others."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias("number"), row), "numbered")
    texts = numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))
    lost = minhash.near_duplicates(texts, k=5, percent=80).where("not kept").select(F.col("doc_id").alias("number"))
    return numbered.join(lost, "number", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in training order."""
    return mixing.mixed(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and whether they decode to it again."""
    rows = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe_tokens", to_tokens),
]

# language identification is a trained model, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
