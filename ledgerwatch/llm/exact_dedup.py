"""Exact duplicates with a heavy-hitter split.

A Misra-Gries pass finds the digests that may be frequent, an exact count
verifies them, and the verified winners (few by construction) are broadcast,
so copies of very common texts are settled map-side where they lie. All other
digests take the ordinary shuffle, where no group can be large any more.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

HEAVY_SHARE = 1e-3      # a digest with at least this share of all rows is heavy; at most 1 / share of them exist


def normalised(text: str = "text") -> Column:
    """Null counts as empty; only A-Z are lower-cased."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest(text: str = "text") -> Column:
    return F.sha2(normalised(text), 256)


def _misra_gries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, int] = {}
        for batch in batches:
            for item in batch.column(0).value_counts():
                name, n = item["values"].as_py(), item["counts"].as_py()
                kept[name] = kept.get(name, 0) + n
            if len(kept) > counters:       # subtract the (counters + 1)-th count from all, as in merging two summaries
                cut = sorted(kept.values(), reverse=True)[counters]
                kept = {k: n - cut for k, n in kept.items() if n > cut}
        yield pa.RecordBatch.from_pydict({"sha": pa.array(list(kept), pa.string()), "low": pa.array(list(kept.values()), pa.int64())})
    return run


def heavy_digests(digests: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """(sha, keep_id, group_size) of every digest of ``digests`` (sha, doc_id)
    that at least ``share`` of all rows have: at most 1 / share rows.

    Each partition keeps 2 / share Misra-Gries counters, whose counts are too
    low by at most share / 2 of its rows; summed over partitions a heavy digest
    still shows at least share / 2 of all rows. Only digests that do are
    counted exactly (at most 2 / share of them, broadcast), which verifies the
    winners."""
    counters = math.ceil(2 / share)
    found = digests.select("sha").mapInArrow(_misra_gries(counters), "sha string, low long").groupBy("sha").agg(F.sum("low").alias("low"))
    rows = digests.agg(F.count("*").alias("rows"))
    likely = found.join(F.broadcast(rows), F.col("low") * counters >= F.col("rows")).select("sha")
    exact = digests.join(F.broadcast(likely), "sha").groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return exact.join(F.broadcast(rows), F.col("group_size") >= F.ceil(F.col("rows") * share)).select("sha", "keep_id", "group_size")


def duplicate_report(docs: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: doc_id, keep_id (largest
    doc_id of the equal texts), group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null and empty texts
    are equal. A null doc_id ranks below all others, so such a row stays only
    when its whole group has none (keep_id is null then). Of rows that repeat
    both text and doc_id exactly one is marked kept. Other columns are ignored.
    An empty table gives an empty result. No row is collected, and no task gets
    all rows of a heavy group."""
    digests = materialize(docs.select("doc_id", digest().alias("sha")), "digests")
    heavy = materialize(heavy_digests(digests, share), "heavy")
    winners = F.broadcast(heavy)
    group = Window.partitionBy("sha").orderBy(F.col("doc_id").desc_nulls_last())
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    light = digests.join(F.broadcast(heavy.select("sha")), "sha", "left_anti").select(
        "doc_id", F.max("doc_id").over(whole).alias("keep_id"), F.count("*").over(whole).alias("group_size"),
        (F.row_number().over(group) == 1).alias("kept"), "sha")
    common = digests.join(winners, "sha").select("doc_id", "keep_id", "group_size", "sha")
    lost = common.where("not (doc_id <=> keep_id)").select("doc_id", "keep_id", "group_size", F.lit(False).alias("kept"), "sha")
    # a row that repeats the winning doc_id too: count the copies, mark one
    won = common.where("doc_id <=> keep_id").groupBy("doc_id", "keep_id", "group_size", "sha").agg(F.count("*").alias("n"))
    won = won.select("doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1), "n")).alias("copy"), "sha").select(
        "doc_id", "keep_id", "group_size", (F.col("copy") == 1).alias("kept"), "sha")
    return light.unionByName(lost).unionByName(won).withColumnRenamed("sha", "text_sha256")


def exact_dedup(docs: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per text,
    that of the largest doc_id (see ``duplicate_report``); of rows that share
    it too, the one whose columns hash lowest."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.col("doc_id").alias("_id"), digest().alias("_sha"), F.xxhash64(*columns).alias("_mark"), F.struct(*columns).alias("_row"))
    digests = materialize(marked.select(F.col("_id").alias("doc_id"), F.col("_sha").alias("sha")), "digests")
    heavy = materialize(heavy_digests(digests, share).withColumnRenamed("sha", "_sha"), "heavy")
    rank = F.row_number().over(Window.partitionBy("_sha").orderBy(F.col("_id").desc_nulls_last(), "_mark"))
    light = marked.join(F.broadcast(heavy.select("_sha")), "_sha", "left_anti").withColumn("_rank", rank).where("_rank = 1").select("_row")
    common = marked.join(F.broadcast(heavy), "_sha").where("_id <=> keep_id").groupBy("_sha").agg(F.min_by("_row", "_mark").alias("_row")).select("_row")
    return light.unionByName(common).select("_row.*")


ORACLE = """with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents)
select doc_id, max(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size,
  row_number() over (partition by body order by doc_id desc nulls last) = 1 as kept, sha256(body) as text_sha256
from d"""
