"""Registered queries: green metrics and the run register, over a run log
derived from the scored transactions (one run per event day)."""

from __future__ import annotations

from ..operators import green as G
from . import base
from .q_evaluation import CM, _metrics_sql
from .registry import register, rounded
from .sqlbase import with_scored

RUNS = (
    "runs AS (select 'run-' || strftime(d, '%Y%m%d') as run_id, cast(d as timestamp) as start_time, n as records, "
    "dur as duration_seconds, 4 as parallelism, accuracy, false_positive_rate, f1_score, "
    "case when dayofmonth(d) % 7 = 0 then null else dur / 3600.0 * 0.095 * 4 end as energy_kwh from ("
    + _metrics_sql(f"select cast(transaction_timestamp as date) as d, cast(sum(cast(transaction_amount as decimal(38,8))) as double) as dur, {CM} "
                   "from scored group by 1", "d, dur") + "))")


def runs(spark, sf):
    return G.run_log_from_scored(base.scored_table(spark, sf))


@register("run_log", with_scored(
    "select run_id, start_time, records, round(duration_seconds, 6) as duration_seconds, parallelism, accuracy, "
    "false_positive_rate, f1_score, round(energy_kwh, 6) as energy_kwh from runs", RUNS))
def run_log(spark, sf):
    """The run register fixture: one run per event day with its metrics."""
    return rounded(runs(spark, sf))


@register("green_run_metrics", with_scored(
    "select run_id, records, round(k, 6) as estimated_energy_kwh, round(k * 475.0, 6) as estimated_co2_grams, "
    "round(records / greatest(k, 0.001), 6) as efficiency_records_per_kwh from "
    "(select run_id, records, duration_seconds / 3600.0 * 0.095 * parallelism as k from runs)", RUNS))
def green_run_metrics(spark, sf):
    """Energy, CO2 and efficiency per run."""
    return rounded(G.green_run_metrics(runs(spark, sf)))


@register("green_daily", with_scored(
    "select day, strftime(day, '%a') as weekday, round(kwh, 6) as kwh, round(kwh * 475.0, 6) as co2_grams, "
    "kwh > avg(kwh) over () as above_average from (select cast(start_time as date) as day, "
    "sum(coalesce(energy_kwh, 0.0)) as kwh from runs group by 1)", RUNS))
def green_daily(spark, sf):
    """A31 + A33: daily energy series with the above-average flag."""
    return rounded(G.green_daily(runs(spark, sf)))


TOTALS = ("select sum(coalesce(energy_kwh, 0.0)) as total_energy_kwh, sum(coalesce(energy_kwh, 0.0)) * 475.0 "
          "as total_co2_grams, count(*) as training_runs, sum(records) / greatest(sum(coalesce(energy_kwh, 0.0)), 0.001) "
          "as efficiency_records_per_kwh from runs")


@register("green_totals", with_scored(
    "select round(total_energy_kwh, 6) as total_energy_kwh, round(total_co2_grams, 6) as total_co2_grams, "
    f"training_runs, round(efficiency_records_per_kwh, 6) as efficiency_records_per_kwh from ({TOTALS})", RUNS))
def green_totals(spark, sf):
    """Totals over the run log (missing energy counts as 0)."""
    return rounded(G.green_totals(runs(spark, sf)))


@register("carbon_budget", with_scored(
    "select round(total_energy_kwh, 6) as total_energy_kwh, cast(50.0 as double) as limit_kwh, round(p, 6) as budget_used_pct, "
    "case when p > 80.0 then 'red' when p > 60.0 then 'amber' else 'green' end as status from "
    f"(select total_energy_kwh, total_energy_kwh / 50.0 * 100 as p from ({TOTALS}))", RUNS))
def carbon_budget(spark, sf):
    """Carbon budget used against the 50 kWh limit."""
    return rounded(G.carbon_budget(G.green_totals(runs(spark, sf))))


@register("run_history", with_scored(
    "select run_id, start_time, accuracy, false_positive_rate, f1_score, round(energy_kwh, 6) as energy_kwh from runs "
    "where run_id like 'run-%' order by start_time desc, run_id limit 5", RUNS))
def run_history(spark, sf):
    """K3 + P13: newest 5 runs with the name prefix."""
    return rounded(G.run_history(runs(spark, sf)))


@register("model_health", with_scored(
    "select coalesce(accuracy, 0.924) as accuracy, coalesce(false_positive_rate, 0.051) as false_positive_rate, "
    "coalesce(f1_score, 0.89) as f1_score, run_id, 'local' as mode from (select 1) left join "
    "(select * from runs order by start_time desc, run_id desc limit 1) on true", RUNS))
def model_health(spark, sf):
    """M11 + F17: latest run's metrics over the defaults."""
    return rounded(G.model_health(runs(spark, sf)))
