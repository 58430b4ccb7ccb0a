"""Score drift: equal-width histograms with edges from the baseline, PSI,
KL divergence, the drift report and the retrain / consecutive-drift rules.

Histograms are group-by aggregates (partial aggregation on every executor,
a handful of bins per group after the shuffle). Baseline edges are a
one-row aggregate broadcast to every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import params as P
from ..sources import versions as V
from .evaluation import confusion_counts, ratio


def baseline_edges(baseline: DataFrame, col: str = "score") -> DataFrame:
    """One row (lo, hi, n_base). Equal min and max widen by 0.5 each side,
    as NumPy does."""
    s = baseline.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"), F.count(F.col(col)).alias("n_base"))
    same = F.col("_mn") == F.col("_mx")
    return s.select(F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
                    F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"), "n_base")


def with_bin(df: DataFrame, edges: DataFrame, col: str, bins: int) -> DataFrame:
    """Bin index 0..bins-1, left-closed, last bin right-closed; values
    outside [lo, hi] get a null bin (dropped from counts, kept in totals)."""
    x, lo, hi = F.col(col), F.col("lo"), F.col("hi")
    b = F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1))
    return df.crossJoin(F.broadcast(edges)).withColumn("bin", F.when((x >= lo) & (x <= hi), b.cast("int")))


def histogram(df: DataFrame, edges: DataFrame, col: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """(by..., bin, count) for every bin (empty bins included), plus the
    group's total row count (out-of-range rows included)."""
    by = by or []
    binned = with_bin(df.where(F.col(col).isNotNull()), edges, col, bins)
    counts = binned.where(F.col("bin").isNotNull()).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"))
    totals = binned.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    spine = totals.select(*by, "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, [*by, "bin"], "left").select(*by, "bin", F.coalesce("count", F.lit(0)).alias("count"), "total")


def psi_terms(baseline: DataFrame, current: DataFrame, col: str = "score", bins: int = P.PSI_BINS,
              by: list[str] | None = None) -> DataFrame:
    """Per-bin PSI terms (by..., bin, b_pct, c_pct, term)."""
    by = by or []
    edges = baseline_edges(baseline, col)
    bh = histogram(baseline, edges, col, bins).select("bin", F.col("count").alias("b_count"),
                                                     F.col("total").alias("b_total"))
    ch = histogram(current, edges, col, bins, by)
    j = ch.join(F.broadcast(bh), "bin")
    b_pct = (F.col("b_count") + P.PSI_EPS) / F.col("b_total")
    c_pct = (F.col("count") + P.PSI_EPS) / F.col("total")
    return j.select(*by, "bin", b_pct.alias("b_pct"), c_pct.alias("c_pct"),
                    ((c_pct - b_pct) * F.ln(c_pct / b_pct)).alias("term"))


def psi(baseline: DataFrame, current: DataFrame, col: str = "score", bins: int = P.PSI_BINS,
        by: list[str] | None = None) -> DataFrame:
    """Population stability index of current against baseline."""
    by = by or []
    return psi_terms(baseline, current, col, bins, by).groupBy(*by).agg(F.sum("term").alias("psi"))


def kl_divergence(baseline: DataFrame, current: DataFrame, col: str = "score", bins: int = P.KL_BINS,
                  by: list[str] | None = None) -> DataFrame:
    """KL(current ‖ baseline) over densities on the baseline's edges,
    each smoothed by 1e-10 and renormalised. No current value in range →
    null (NumPy gives NaN)."""
    by = by or []
    edges = baseline_edges(baseline, col)
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)

    def dens(h: DataFrame, name: str, group: list[str]) -> DataFrame:
        w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
        inr = F.sum("count").over(w)
        return h.crossJoin(F.broadcast(edges.select("lo", "hi"))).select(
            *group, "bin", (F.col("count") / (inr * width)).alias(name))

    bd = dens(histogram(baseline, edges, col, bins), "_bd", [])
    cd = dens(histogram(current, edges, col, bins, by), "_cd", by)
    j = cd.join(F.broadcast(bd), "bin")
    p = F.col("_cd") + P.KL_EPS
    q = F.col("_bd") + P.KL_EPS
    g = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    j = j.select(*by, (p / F.sum(p).over(g)).alias("_p"), (q / F.sum(q).over(g)).alias("_q"))
    return j.groupBy(*by).agg(F.sum(F.col("_p") * F.ln(F.col("_p") / F.col("_q"))).alias("kl_divergence"))


def bin_counts(df: DataFrame, edges: DataFrame, col: str = "score", by: list[str] | None = None, extra: list | None = None) -> DataFrame:
    """One row per group: total (values, out-of-range ones included), sum, and
    bins, the counts of KL_BINS equal-width bins between the edges. Rows of
    several tables with the same edges add up, bin by bin (see ``merged``); PSI's
    bins are pairs of these. One partial aggregation."""
    binned = with_bin(df, edges, col, P.KL_BINS)
    return binned.groupBy(*(by or [])).agg(
        F.count(col).alias("total"), F.sum(col).alias("sum"),
        F.array(*[F.count_if(F.col("bin") == i) for i in range(P.KL_BINS)]).alias("bins"), *(extra or []))


def merged(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of ``bin_counts`` added up over groups, batches or days."""
    return counts.groupBy(*(by or [])).agg(F.sum("total").alias("total"), F.sum("sum").alias("sum"),
                                           F.array(*[F.sum(F.col("bins")[i]) for i in range(P.KL_BINS)]).alias("bins"))


def baseline_counts(baseline: DataFrame, col: str = "score") -> DataFrame:
    """The baseline as one row: lo, hi, n_base, b_total, b_sum, b_bins. This is
    all that later comparisons read of it, and what a baseline store keeps."""
    edges = baseline_edges(baseline, col)
    counts = bin_counts(baseline, edges, col).select(F.col("total").alias("b_total"), F.col("sum").alias("b_sum"), F.col("bins").alias("b_bins"))
    return edges.crossJoin(F.broadcast(counts))


def _total(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def _pairs(bins: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(P.KL_BINS // 2 - 1)), lambda i: F.get(bins, 2 * i) + F.get(bins, 2 * i + 1))


def with_drift(counts: DataFrame, base: DataFrame) -> DataFrame:
    """Rows of ``bin_counts`` with psi and kl_divergence against a one-row
    ``baseline_counts``; null without values (psi) or values in range (KL)."""
    b, c = F.col("b_bins"), F.col("bins")

    def psi_term(n: Column, m: Column) -> Column:
        now, then = (n + P.PSI_EPS) / F.col("total"), (m + P.PSI_EPS) / F.col("b_total")
        return (now - then) * F.ln(now / then)

    def smooth(bins: Column) -> Column:
        inside = F.aggregate(bins, F.lit(0).cast("long"), lambda acc, n: acc + n)
        return F.when(inside > 0, F.transform(bins, lambda n: n / (inside * ((F.col("hi") - F.col("lo")) / P.KL_BINS)) + P.KL_EPS))

    def kl_term(p: Column, q: Column) -> Column:
        p, q = p / _total(F.col("_p")), q / _total(F.col("_q"))
        return p * F.ln(p / q)

    both = counts.crossJoin(F.broadcast(base)).withColumn("_p", smooth(c)).withColumn("_q", smooth(b))
    psi_value = F.when((F.col("total") > 0) & (F.col("b_total") > 0), _total(F.zip_with(_pairs(c), _pairs(b), psi_term)))
    return both.withColumn("psi", psi_value).withColumn("kl_divergence", _total(F.zip_with("_p", "_q", kl_term))).drop("_p", "_q")


def drift_report(scored: DataFrame, col: str = "score", cohort: str = "cohort",
                 baseline: str = "baseline", current: str = "current") -> DataFrame:
    """A16 + G5 + G6: one report row comparing the current cohort's scores with
    the baseline cohort's. Two passes: the baseline's edges, then bins, sums and
    confusion counts of both cohorts in one aggregation."""
    edges = baseline_edges(scored.where(F.col(cohort) == baseline), col)
    both = bin_counts(scored.where(F.col(cohort).isin(baseline, current)), edges, col, [cohort], confusion_counts())
    right = F.col("tn") + F.col("tp")
    facts = F.struct("total", "sum", "bins", ratio(right, right + F.col("fp") + F.col("fn")).alias("accuracy"))
    one = both.agg(F.max(F.when(F.col(cohort) == baseline, facts)).alias("_b"), F.max(F.when(F.col(cohort) == current, facts)).alias("_c"))
    counts = one.select(F.coalesce("_c.total", F.lit(0)).alias("total"), F.col("_c.bins").alias("bins"),
                        F.coalesce("_b.total", F.lit(0)).alias("b_total"), F.col("_b.bins").alias("b_bins"),
                        F.try_divide("_b.sum", "_b.total").alias("baseline_mean"), F.try_divide("_c.sum", "_c.total").alias("current_mean"),
                        F.col("_b.accuracy").alias("_ab"), F.col("_c.accuracy").alias("_ac"))
    rep = with_drift(counts, edges)
    acc_drop = F.coalesce(F.col("_ab") - F.col("_ac"), F.lit(0.0))
    p, kl = F.coalesce(F.col("psi"), F.lit(0.0)), F.coalesce(F.col("kl_divergence"), F.lit(0.0))
    return rep.select(
        "psi", "kl_divergence", acc_drop.alias("accuracy_drop"), "baseline_mean", "current_mean",
        (F.col("psi") > P.PSI_DRIFT).alias("drift_detected"),
        F.when(F.col("psi") > P.PSI_DRIFT, "HIGH").when(F.col("psi") > P.PSI_MEDIUM, "MEDIUM").otherwise("LOW").alias("severity"),
        ((p > P.PSI_DRIFT) & ((acc_drop > P.RETRAIN_ACCURACY_DROP) | (kl > P.RETRAIN_KL))).alias("should_retrain"),
    )


def retrain_signal(report: DataFrame) -> DataFrame:
    """G6 over stored reports: ``psi > .25 and (accuracy_drop > .02 or kl >
    .1)``, absent fields read as 0."""
    p = F.coalesce(F.col("psi"), F.lit(0.0))
    kl = F.coalesce(F.col("kl_divergence"), F.lit(0.0))
    drop = F.coalesce(F.col("accuracy_drop"), F.lit(0.0))
    return report.select(p.alias("psi"), kl.alias("kl_divergence"), drop.alias("accuracy_drop"),
                         ((p > P.PSI_DRIFT) & ((drop > P.RETRAIN_ACCURACY_DROP) | (kl > P.RETRAIN_KL))).alias("should_retrain"))


def severity(psi_value: Column) -> Column:
    """G5."""
    return F.when(psi_value > P.PSI_DRIFT, "HIGH").when(psi_value > P.PSI_MEDIUM, "MEDIUM").otherwise("LOW")


def daily_drift_reports(scored: DataFrame, col: str = "score", ts: str = "transaction_timestamp",
                        cohort: str = "cohort", baseline: str = "baseline", current: str = "current") -> DataFrame:
    """The ``drift_reports`` table: one row per day of the current cohort,
    PSI and KL of that day's scores against the whole baseline cohort, which is
    counted once."""
    base = baseline_counts(scored.where(F.col(cohort) == baseline), col)
    days = scored.where(F.col(cohort) == current).withColumn("report_date", F.to_date(ts))
    counts = bin_counts(days, base.select("lo", "hi"), col, ["report_date"], [F.count(F.lit(1)).alias("n"), F.avg(col).alias("current_mean")])
    return with_drift(counts, base).select(
        "report_date", F.concat(F.lit("drift_"), F.date_format("report_date", "yyyyMMdd")).alias("report_id"),
        "n", "psi", "kl_divergence", "current_mean", (F.col("psi") > P.PSI_DRIFT).alias("drift_detected"), severity(F.col("psi")).alias("severity"))


def drift_against_stored(scores: DataFrame, store: str, col: str = "score") -> DataFrame:
    """One status row of ``scores`` against the baseline kept in ``store``
    (see ``sources.versions``): a first run stores its own scores' counts as the
    baseline, later runs compare with it; ``no_data`` without scores, which are
    not stored either."""
    spark = scores.sparkSession
    if V.latest(spark, store) is None and scores.where(F.col(col).isNotNull()).isEmpty():
        return spark.createDataFrame([(False, 0, None, None, "no_data")], "created boolean, n long, psi double, kl_divergence double, status string")
    base, created = V.read_or_create(spark, store, lambda: baseline_counts(scores, col))
    counts = bin_counts(scores, base.select("lo", "hi"), col)
    status = (F.when(F.col("total") == 0, "no_data").when(F.lit(created), "baseline_stored").when(F.col("psi") > P.PSI_DRIFT, "drift").otherwise("ok"))
    return with_drift(counts, base).select(F.lit(created).alias("created"), F.col("total").alias("n"), "psi", "kl_divergence", status.alias("status"))


def drift_history(reports: DataFrame, n: int = 7) -> DataFrame:
    """K4: the newest ``n`` reports, oldest first."""
    return reports.orderBy(F.col("report_date").desc()).limit(n).orderBy("report_date")


def consecutive_drift(reports: DataFrame, threshold: float = P.PSI_DRIFT, min_days: int = P.CONSECUTIVE_DAYS) -> DataFrame:
    """Runs of at least ``min_days`` consecutive days with PSI above the
    threshold (gaps and islands). One row per report day → small input."""
    hot = reports.where(F.col("psi") > threshold).select("report_date", "psi")
    w = Window.orderBy("report_date")
    isl = hot.withColumn("_g", F.date_sub(F.col("report_date"), F.row_number().over(w).cast("int")))
    runs = isl.groupBy("_g").agg(F.min("report_date").alias("run_start"), F.max("report_date").alias("run_end"),
                                 F.count(F.lit(1)).alias("days"), F.max("psi").alias("max_psi"))
    return runs.where(F.col("days") >= min_days).select("run_start", "run_end", "days", "max_psi")


def drift_status(scored: DataFrame, cohorts: list[str], col: str = "score", cohort: str = "cohort",
                 baseline: str = "baseline") -> DataFrame:
    """Status per requested cohort: ``no_data`` when it has no scores,
    otherwise its PSI against the baseline cohort and ``ok``/``drift``."""
    b = scored.where(F.col(cohort) == baseline)
    present = psi(b, scored.where(F.col(cohort).isin(cohorts)), col, by=[cohort])
    counts = scored.where(F.col(cohort).isin(cohorts)).groupBy(cohort).agg(F.count(F.lit(1)).alias("n"))
    spine = counts.sparkSession.createDataFrame([(c,) for c in cohorts], f"{cohort} string")
    j = spine.join(counts, cohort, "left").join(present, cohort, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    return j.select(cohort, n.alias("n"), "psi",
                    F.when(n == 0, "no_data").when(F.col("psi") > P.PSI_DRIFT, "drift").otherwise("ok").alias("status"))
