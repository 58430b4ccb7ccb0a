"""Mixing sources to target weights with a time-varying curriculum, in
DataFrame operations only.

Each source has a weight schedule over training time u in [0, 1]: its density
is ``1 + c * (2u - 1)`` times its target, so a share that fades in (c > 0),
fades out (c < 0) or holds (c = 0). The integral of the schedule is the
source's cumulative token demand, ``target * ((1 - c) * u + c * u * u)``; a
document that begins after the first y tokens of its source is trained on when
demand reaches y, which the inverse of that quadratic gives in closed form.
Range-sorting all documents by that position mixes the sources as scheduled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)        # by source in order of code points, repeating
FADES = (-0.5, 0.5, 0.0)         # schedule slope by source, repeating
SHARE = 1.5                      # words of the mix, as a share of all words
MOST = 2.0                       # a source, and a document, is taken at most this often
RANGE_ROWS = 1 << 16             # rows of a hash range, on average


def _cycle(values: tuple[float, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, fades: tuple[float, ...] = FADES,
                   share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target, fade) from ``sizes`` (source, size): the
    words of the mix shared by weight, no source above ``most`` times its size
    and the excess reshared by weight until none is above.

    Resharing ends at target = min(most * size, level * weight). Sources are
    taken in order of most * size / weight; the level is the first at which the
    rest, shared by weight over the sources not yet full, fills none (levels
    computed further on are lower, as they count sources full that aren't, so
    it is the largest that fits). The windows run over one row per source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sources.select("source", "source_size", _cycle(weights, rank).alias("weight"), _cycle(fades, rank).alias("fade"))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(most)).withColumn("full_at", F.col("most") / F.col("weight"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    here = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(share)
    level = (total - F.coalesce(F.sum("most").over(here), F.lit(0.0))) / F.sum("weight").over(rest)
    fits = F.when(F.col("level") <= F.col("full_at"), F.col("level"))
    return (ranked.withColumn("level", level).withColumn("first", F.max(fits).over(everything))
            .select("source", "source_size", F.least(F.col("most"), F.coalesce(F.col("first") * F.col("weight"), F.col("most"))).alias("target"), "fade"))


def position(y: Column, fade: Column) -> Column:
    """The time at which a source's demand reaches the share y of its target."""
    return 2 * y / ((1 - fade) + F.sqrt((1 - fade) * (1 - fade) + 4 * fade * y))


def assign(docs: DataFrame, whole: bool = False, **mix) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (words of the whole
    text, null text 0), source_size, target (of its source), taken (words the
    mix takes, repeats counted), position (0 to 1, when the document is first
    trained on; null if it isn't), again (when it is trained on for the second
    time; null if it isn't), sorted by position.

    A source's documents line up in order of md5(doc_id) (of the text where
    doc_id is null; ties: doc_id, size), and again for the second pass; the mix takes words until the target is
    reached. The last document of a source is cut there, so taken sums to the
    target rounded down; with ``whole`` it is taken whole if the cut falls in
    its second half and else not at all.

    Running sums over a source add up (source, hash range) totals and a sum
    inside each range. There are at least 4096 ranges, and so many that
    documents of different ids come to at most RANGE_ROWS a range on average
    whatever the table's size; their number changes no result. Only rows of
    one doc_id (or of none and one text) and source must meet in a task. A null
    source is a source of its own, in the last place; repeated rows are
    documents like others.
    Sources without words have target 0. An empty table gives an empty result."""
    out = _lined(docs, [], whole, mix)
    return out.orderBy("position", "doc_id", "size")


def _sized(docs: DataFrame, extra: list[Column]) -> DataFrame:
    """Size and place of every document; ``key`` is its source, never null."""
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))).alias("spot"), *extra)
    return sized.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))


def _digits(rows: int, range_rows: int) -> int:
    """Hexadecimal digits of the place that number the ranges."""
    digits = 3
    while rows > range_rows << 4 * digits:
        digits += 1
    return digits


def _lined(docs: DataFrame, extra: list[Column], whole: bool, mix: dict) -> DataFrame:
    sized = materialize(_sized(docs, []), "sized")
    bucket = F.substring("spot", 1, _digits(sized.count(), RANGE_ROWS)).alias("bucket")
    targets = source_targets(sized, **mix).withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    ranges = sized.groupBy("key", bucket).agg(F.sum("size").alias("inside"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("key", "bucket", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("base")).join(targets, "key")
    ranges = materialize(ranges, "ranges")
    rows = (_sized(docs, extra) if extra else sized).select("*", bucket)
    # the running sum and the join below share one shuffle by (key, bucket)
    local = Window.partitionBy("key", "bucket").orderBy("spot", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    lined = rows.withColumn("ahead", F.coalesce(F.sum("size").over(local), F.lit(0))).join(ranges, ["key", "bucket"])
    begin = F.col("base") + F.col("ahead")
    want = F.floor("target")
    got = [F.greatest(F.lit(0), F.least(F.col("size"), want - begin - n * F.col("source_size"))) for n in (0, 1)]
    if whole:
        got = [F.when(2 * g >= F.col("size"), F.col("size")).otherwise(F.lit(0)) for g in got]
    taken = (got[0] + got[1]).cast("long")
    # the second pass of a source begins when demand reaches its size
    when = [F.when(got[n] > 0, position(F.least(F.lit(1.0), (begin + n * F.col("source_size")) / F.col("target")), F.col("fade"))) for n in (0, 1)]
    names = [c for c in rows.columns if c not in ("key", "bucket", "spot")]
    return lined.select(*names, "source_size", "target", taken.alias("taken"), when[0].alias("position"), when[1].alias("again"))


def mixed(docs: DataFrame, **mix) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them (whole documents, so
    up to half a document from the target at a source's cut), sorted by
    training position: every copy has its own, so a source that is passed over
    twice keeps its schedule to the end. Columns are those of ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    plan = _lined(docs, [row], True, mix).where("taken > 0")
    copies = plan.select("_row", "doc_id", F.explode(F.array_compact(F.array("position", "again"))).alias("at"))
    return copies.orderBy("at", "doc_id").select("_row.*")


ORACLE = r"""with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), text, '')) as spot from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size from d group by source),
r as (
  select *, [3.0, 1.0, 2.0][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)]::double as weight,
    [-0.5, 0.5, 0.0][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)]::double as fade from s),
l as (
  select *, source_size * 2.0::double as most,
    (1.5::double * sum(source_size) over () - coalesce(sum(source_size * 2.0::double) over (order by source_size * 2.0::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by source_size * 2.0::double / weight, source nulls last rows between current row and unbounded following) as level from r),
t as (
  select source, source_size, fade, least(most, coalesce(max(case when level <= most / weight then level end) over () * weight, most)) as target from l),
p as (
  select d.doc_id, d.size, t.source_size, t.target, t.fade,
    coalesce(sum(d.size) over (partition by d.source order by spot, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as ahead
  from d join t on d.source is not distinct from t.source),
g as (
  select *, cast(greatest(0, least(size, floor(target) - ahead)) + greatest(0, least(size, floor(target) - ahead - source_size)) as bigint) as taken,
    least(1.0, ahead / target) as y, floor(target) - ahead - source_size > 0 and size > 0 as twice,
    least(1.0, (ahead + source_size) / target) as z from p)
select doc_id, size, source_size, round(target, 6) as target, taken,
  case when taken > 0 then round(2 * y / ((1 - fade) + sqrt((1 - fade) * (1 - fade) + 4 * fade * y)), 9) end as position,
  case when twice then round(2 * z / ((1 - fade) + sqrt((1 - fade) * (1 - fade) + 4 * fade * z)), 9) end as again
from g"""
