"""Registered queries: histograms, PSI, KL, drift reports and drift rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from .. import params as P
from ..session import scratch_path
from . import base
from .registry import register, rounded
from .sqlbase import with_scored

EDGES = ("edges AS (select case when min(score) = max(score) then min(score) - 0.5 else min(score) end as lo, "
         "case when min(score) = max(score) then max(score) + 0.5 else max(score) end as hi "
         "from scored where cohort = 'baseline' and score is not null)")


def hist_ctes(nbins: int, group: str, name: str, where: str = "") -> list[str]:
    """CTEs ``{name}`` = (grp, bin, cnt, total) with empty bins included."""
    cond = f"and {where}" if where else ""
    return [
        f"{name}_binned AS (select {group} as grp, case when s.score >= e.lo and s.score <= e.hi then "
        f"cast(least(floor((s.score - e.lo) / (e.hi - e.lo) * {nbins}), {nbins - 1}) as integer) end as bin "
        f"from scored s cross join edges e where s.score is not null {cond})",
        f"{name}_tot AS (select grp, count(*) as total from {name}_binned group by grp)",
        f"{name}_cnt AS (select grp, bin, count(*) as c from {name}_binned where bin is not null group by grp, bin)",
        f"{name} AS (select t.grp, cast(r.range as integer) as bin, coalesce(c.c, 0) as cnt, t.total "
        f"from {name}_tot t cross join range(0, {nbins}) r left join {name}_cnt c on c.grp = t.grp and c.bin = r.range)",
    ]


PSI_CTES = [EDGES, *hist_ctes(10, "'b'", "hb", "cohort = 'baseline'"),
            *hist_ctes(10, "'c'", "hc", "cohort = 'current'")]
PSI_BODY = ("select sum((cp - bp) * ln(cp / bp)) as psi from (select (c.cnt + 1e-6) / c.total as cp, "
            "(b.cnt + 1e-6) / b.total as bp from hc c join hb b on c.bin = b.bin)")
KL_CTES = [EDGES, *hist_ctes(20, "'b'", "kb", "cohort = 'baseline'"),
           *hist_ctes(20, "'c'", "kc", "cohort = 'current'")]


def kl_body(cur: str = "kc", by_grp: bool = False) -> str:
    g = "c.grp, " if by_grp else ""
    part = "partition by c.grp" if by_grp else ""
    part2 = "partition by grp" if by_grp else ""
    return (
        f"select {'grp, ' if by_grp else ''}sum(p * ln(p / q)) as kl_divergence from ("
        f"select {'grp, ' if by_grp else ''}pr / sum(pr) over ({part2}) as p, qr / sum(qr) over ({part2}) as q from ("
        f"select {g}c.cnt / (sum(c.cnt) over ({part}) * ((e.hi - e.lo) / 20)) + 1e-10 as pr, "
        f"b.cnt / (sum(b.cnt) over ({part}) * ((e.hi - e.lo) / 20)) + 1e-10 as qr "
        f"from {cur} c join kb b on c.bin = b.bin cross join edges e))"
        f"{' group by grp' if by_grp else ''}"
    )


def cohorts(spark, sf):
    s = base.scored_table(spark, sf)
    return s, s.where(F.col("cohort") == "baseline"), s.where(F.col("cohort") == "current")


@register("score_histogram", with_scored(
    "select grp as cohort, bin, cnt as count, total from hb union all select grp, bin, cnt, total from hc",
    EDGES, *[c.replace("'b'", "'baseline'") for c in hist_ctes(10, "'b'", "hb", "cohort = 'baseline'")],
    *[c.replace("'c'", "'current'") for c in hist_ctes(10, "'c'", "hc", "cohort = 'current'")]))
def score_histogram(spark, sf):
    """10 equal-width bins on the baseline's range, per cohort."""
    s, b, _ = cohorts(spark, sf)
    edges = D.baseline_edges(b)
    return D.histogram(s, edges, "score", 10, ["cohort"])


@register("psi", with_scored(f"select round(psi, 6) as psi from ({PSI_BODY})", *PSI_CTES))
def psi(spark, sf):
    """PSI of the current cohort's scores against the baseline's."""
    _, b, c = cohorts(spark, sf)
    return rounded(D.psi(b, c))


@register("kl_divergence", with_scored(f"select round(kl_divergence, 6) as kl_divergence from ({kl_body()})", *KL_CTES))
def kl_divergence(spark, sf):
    """KL(current ‖ baseline) on 20 bins."""
    _, b, c = cohorts(spark, sf)
    return rounded(D.kl_divergence(b, c))


ACC_BY_COHORT = ("acc AS (select max(case when cohort = 'baseline' then a end) as ab, "
                 "max(case when cohort = 'current' then a end) as ac from (select cohort, "
                 "count(*) filter (where is_fraud = prediction) / count(*) as a from scored group by cohort))")
MEANS = ("means AS (select avg(case when cohort = 'baseline' then score end) as baseline_mean, "
         "avg(case when cohort = 'current' then score end) as current_mean from scored)")
REPORT_BODY = (
    "select round(psi, 6) as psi, round(kl_divergence, 6) as kl_divergence, round(coalesce(ab - ac, 0.0), 6) as accuracy_drop, "
    "round(baseline_mean, 6) as baseline_mean, round(current_mean, 6) as current_mean, psi > 0.25 as drift_detected, "
    "case when psi > 0.25 then 'HIGH' when psi > 0.1 then 'MEDIUM' else 'LOW' end as severity, "
    "coalesce(psi, 0) > 0.25 and (coalesce(ab - ac, 0.0) > 0.02 or coalesce(kl_divergence, 0) > 0.1) as should_retrain "
    f"from ({PSI_BODY}) cross join ({kl_body()}) cross join means cross join acc")


@register("drift_report", with_scored(REPORT_BODY, *PSI_CTES, *KL_CTES[1:], MEANS, ACC_BY_COHORT))
def drift_report(spark, sf):
    """A16 + G5: PSI, KL, means, severity, drift flag, retrain flag."""
    return rounded(D.drift_report(base.scored_table(spark, sf)))


@register("retrain_signal", with_scored(
    "select psi, kl_divergence, accuracy_drop, should_retrain from (" + REPORT_BODY + ")",
    *PSI_CTES, *KL_CTES[1:], MEANS, ACC_BY_COHORT))
def retrain_signal(spark, sf):
    """Psi > .25 and (accuracy drop > .02 or kl > .1) over the drift report."""
    rep = D.drift_report(base.scored_table(spark, sf))
    return rounded(D.retrain_signal(rep))


DAILY_CTES = [EDGES, *hist_ctes(10, "'b'", "hb", "cohort = 'baseline'"),
              *hist_ctes(10, "cast(transaction_timestamp as date)", "hd", "cohort = 'current'"),
              *hist_ctes(20, "'b'", "kb", "cohort = 'baseline'"),
              *hist_ctes(20, "cast(transaction_timestamp as date)", "kd", "cohort = 'current'")]
DAILY_BODY = (
    "select d.grp as report_date, 'drift_' || strftime(d.grp, '%Y%m%d') as report_id, n.n, d.psi, k.kl_divergence, "
    "n.current_mean, d.psi > 0.25 as drift_detected, "
    "case when d.psi > 0.25 then 'HIGH' when d.psi > 0.1 then 'MEDIUM' else 'LOW' end as severity from "
    "(select c.grp, sum(((c.cnt + 1e-6) / c.total - (b.cnt + 1e-6) / b.total) * ln(((c.cnt + 1e-6) / c.total) / "
    "((b.cnt + 1e-6) / b.total))) as psi from hd c join hb b on c.bin = b.bin group by c.grp) d "
    f"join ({kl_body('kd', True)}) k on k.grp = d.grp "
    "join (select cast(transaction_timestamp as date) as grp, count(*) as n, avg(score) as current_mean from scored "
    "where cohort = 'current' group by 1) n on n.grp = d.grp"
)


def _round_sql(body: str, cols: str) -> str:
    return f"select {cols} from ({body})"


DAILY_ROUNDED = _round_sql(DAILY_BODY, "report_date, report_id, n, round(psi, 6) as psi, round(kl_divergence, 6) as "
                                       "kl_divergence, round(current_mean, 6) as current_mean, drift_detected, severity")


def daily_reports(spark, sf):
    return D.daily_drift_reports(base.scored_table(spark, sf))


@register("drift_reports", with_scored(DAILY_ROUNDED, *DAILY_CTES))
def drift_reports(spark, sf):
    """The daily ``drift_reports`` table: each current day against the baseline."""
    return rounded(daily_reports(spark, sf))


@register("drift_history", with_scored(
    f"select * from ({DAILY_ROUNDED}) order by report_date desc limit 7", *DAILY_CTES))
def drift_history(spark, sf):
    """K4: the newest 7 reports, oldest first."""
    return rounded(D.drift_history(daily_reports(spark, sf)))


@register("consecutive_drift", with_scored(
    "select min(report_date) as run_start, max(report_date) as run_end, count(*) as days, round(max(psi), 6) as max_psi "
    "from (select report_date, psi, report_date - cast(row_number() over (order by report_date) as integer) as g "
    f"from ({DAILY_BODY}) where psi > 0.25) group by g having count(*) >= 3", *DAILY_CTES))
def consecutive_drift(spark, sf):
    """Runs of at least 3 consecutive days with daily PSI above 0.25 (none
    where scores hold steady)."""
    return rounded(D.consecutive_drift(daily_reports(spark, sf), threshold=P.PSI_DRIFT))


@register("drift_status_empty", with_scored(
    "select s.cohort, coalesce(c.n, 0) as n, round(p.psi, 6) as psi, case when coalesce(c.n, 0) = 0 then 'no_data' "
    "when p.psi > 0.25 then 'drift' else 'ok' end as status from (select unnest(['baseline', 'current', 'holdout']) as cohort) s "
    "left join (select cohort, count(*) as n from scored group by cohort) c on c.cohort = s.cohort "
    "left join (select 'current' as cohort, psi from (" + PSI_BODY + ") union all select 'baseline', psi from (" +
    PSI_BODY.replace("from hc c", "from hb2 c") + ")) p on p.cohort = s.cohort",
    *PSI_CTES, *hist_ctes(10, "'b'", "hb2", "cohort = 'baseline'")))
def drift_status_empty(spark, sf):
    """Per cohort, ``no_data`` when it holds no scores (``holdout`` here)."""
    return rounded(D.drift_status(base.scored_table(spark, sf), ["baseline", "current", "holdout"]))


@register("stored_drift", with_scored(
    "select 1 as run, true as created, (select count(*) from scored where cohort = 'baseline' and score is not null) as n, cast(0.0 as double) as psi, "
    "cast(0.0 as double) as kl_divergence, 'baseline_stored' as status union all "
    "select 2, false, (select count(*) from scored where cohort = 'current' and score is not null), round(psi, 6), round(kl_divergence, 6), "
    f"case when psi > 0.25 then 'drift' else 'ok' end from ({PSI_BODY}) cross join ({kl_body()}) union all "
    "select 3, false, 0, null, null, 'no_data'", *PSI_CTES, *KL_CTES[1:]))
def stored_drift(spark, sf):
    """Three runs against one baseline store: the first stores the
    baseline cohort, the second compares the current cohort with it, the third
    has no scores."""
    s = base.scored_table(spark, sf)
    store = scratch_path(spark, "score-baseline")
    runs = [D.drift_against_stored(s.where(F.col("cohort") == c), store).select(F.lit(i + 1).alias("run"), "*") for i, c in enumerate(("baseline", "current", "holdout"))]
    return rounded(runs[0].unionByName(runs[1]).unionByName(runs[2]))
