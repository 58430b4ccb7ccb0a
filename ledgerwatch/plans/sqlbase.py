"""Oracle SQL building blocks (DuckDB dialect): the transactions view and the
feature / scoring chain written as CTEs, so each oracle query is standalone
over the driver's pre-registered tables."""

from __future__ import annotations

TX = """transactions AS (
  select e.event_id as transaction_id, e.user_id as customer_id, e.ts as transaction_timestamp,
         e.value as transaction_amount, e.event_type as merchant_category, mod(e.k*7,97) as merchant_id,
         mn.n_name as merchant_country, cn.n_name as customer_country,
         cast(30+mod(e.user_id*251,3620) as bigint) as customer_age_days,
         case when mod(e.event_id,97)=0 then null
              else concat('DEV-', cast(1000+mod(e.event_id*13,8999) as varchar)) end as device_fingerprint,
         cast(case when e.event_type='error' and e.value>100 then 1 else 0 end as integer) as is_fraud,
         cast(12+mod(e.event_id*31,74) as bigint) as processing_time_ms,
         case when 30+mod(e.user_id*251,3620)<365 then 'New Customer' when c.c_acctbal>=6000 then 'High Value'
              when c.c_acctbal>=2000 then 'Mid Value' else 'Low Value' end as customer_segment,
         case when mn.n_regionkey<>cn.n_regionkey then 'International'
              when mn.n_nationkey<>cn.n_nationkey then 'Cross-Border' else 'Domestic' end as region,
         case when 30+mod(e.user_id*251,3620)<1095 then 'young'
              when 30+mod(e.user_id*251,3620)<2190 then 'middle' else 'senior' end as age_band,
         case when e.ts < timestamp '2024-01-16 00:00:00' then 'baseline' else 'current' end as cohort
  from (select *, cast(json_extract_string(props,'$.k') as bigint) as k from events) e
  left join customer c on c.c_custkey=e.user_id
  left join nation cn on cn.n_nationkey=c.c_nationkey
  left join nation mn on mn.n_nationkey=case when mod(e.k,10)<6 then c.c_nationkey else mod(e.k,25) end
)"""

TRAILING = """trail AS (
  select t.*,
         count(transaction_id) over (partition by customer_id order by transaction_timestamp
             range between interval 7 days preceding and current row) as tx_count_7d,
         avg(cast(transaction_amount as decimal(38,8))) over (partition by customer_id order by transaction_timestamp
             range between interval 30 days preceding and current row) as avg_amount_30d,
         count(merchant_id) over (partition by customer_id order by transaction_timestamp
             range between interval 30 days preceding and current row) as merchant_count_30d
  from transactions t
)"""

FEATURES = """features AS (
  select *,
         0.3*amount_deviation_ratio + 0.25*is_new_merchant + 0.25*is_cross_border
           + 0.2*(case when tx_count_7d > 20 then 1.0 else 0.0 end) as rule_based_risk
  from (
    select *,
           transaction_amount / (avg_amount_30d + 0.01) as amount_deviation_ratio,
           cast(hour(transaction_timestamp) as integer) as hour_of_day,
           cast(dayofweek(transaction_timestamp) in (0, 6) as integer) as is_weekend,
           cast(merchant_count_30d = 1 as integer) as is_new_merchant,
           case when merchant_country <> customer_country then 1 else 0 end as is_cross_border
    from trail)
)"""

SCORED = """scored AS (
  select *, cast(case when score > 0.65 then 1 else 0 end as integer) as prediction
  from (select *, least(greatest(rule_based_risk, 0.0), 1.0) as score from features)
)"""


def with_tx(body: str) -> str:
    return f"WITH {TX}\n{body}"


def with_features(body: str) -> str:
    return f"WITH {TX},\n{TRAILING},\n{FEATURES}\n{body}"


def with_features_and(extra: str, body: str) -> str:
    return f"WITH {TX},\n{TRAILING},\n{FEATURES},\n{extra}\n{body}"


def with_scored(body: str, *extra: str) -> str:
    ctes = [TX, TRAILING, FEATURES, SCORED, *extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body
