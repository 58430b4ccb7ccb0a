"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator with production parameters to the whole
intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, conversation_repair, embed_dedup, exact_dedup, langid, licenses, minhash, mixing, packing, resampling, token_lm, url_filter

ODD_TEXT = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)], turns.schema)
    read = chat.read_conversations(chat.format_conversations(turns.unionByName(odd)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op4_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lm.score_documents(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.assign(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", F.round("position", 9).alias("position"), F.round("again", 9).alias("again"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return read.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.digests(conversation_repair.damaged(table(spark, sf_dir, "conversations")), dropped="dropped")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_near_dedup, op2_exact_dedup, op3_chat_formatting, op4_token_packing, op5_minhash_near_dedup, op6_lm_scoring, op7_language_id, op8_source_mixing, op9_license_scan, op10_bpe_round_trip,
        op11_conversation_repair, op12_url_filter, op13_importance_resampling)}

ORACLE = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op3_chat_formatting": chat.ORACLE,
    "op8_source_mixing": mixing.ORACLE,
    "op12_url_filter": url_filter.ORACLE,
    "op13_importance_resampling": resampling.ORACLE,
}
