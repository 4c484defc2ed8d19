"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the model definitions, not generated from the Spark
plans. Two parity rules apply (see README):
* Spark rounds a double through its shortest decimal text; DuckDB rounds the
  binary value. ``rnd`` makes DuckDB round the decimal text too.
* date_diff counts are BIGINT in DuckDB; cast to INTEGER like Spark.
"""

from __future__ import annotations


def rnd(x: str, n: int) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), {n}) as double)"


AS_OF_DATE = "date '2024-01-31'"
AS_OF_TS = "timestamp '2024-01-31 00:00:00'"
RUN_TS = "timestamp '2024-01-31 00:00:00'"

LOAN_EVENTS = """
select
  concat('EV-', cast(event_id as varchar)) as event_id,
  concat('LN-', cast(user_id as varchar)) as loan_id,
  case when event_id % 101 = 0 then null else concat('BRW-', cast(user_id as varchar)) end as borrower_id,
  case cast(user_id % 3 as int) when 0 then 'mortgage_servicer_a' when 1 then 'mortgage_servicer_b' else 'mortgage_servicer_c' end as tenant_id,
  case et when 'signup' then ' origination' when 'purchase' then 'PAYMENT' when 'click' then 'Prepayment ' when 'view' then 'DELINQUENCY' else 'DEFAULT' end as event_type,
  case cast(user_id % 5 as int) when 0 then 'conventional' when 1 then 'FHA' when 2 then 'VA' when 3 then 'JUMBO' else 'ARM' end as loan_type,
  case cast(user_id % 4 as int) when 0 then 'PURCHASE' when 1 then 'REFINANCE' when 2 then 'CASH_OUT_REFI' else null end as loan_purpose,
  case when event_id % 103 = 0 then null else (date '2014-01-15' + cast(user_id * 37 % 3600 as int)) end as origination_date,
  (date '2014-01-15' + cast(user_id * 37 % 3600 + 5400 + 1800 * (user_id % 4) as int)) as maturity_date,
  case when event_id % 107 = 0 then cast(0 as double) else cast(100000 + user_id * 7919 % 2400000 as double) end as original_balance,
  cast(100000 + user_id * 7919 % 2400000 - event_id % 90000 as double) as current_balance,
  cast(30 + user_id % 56 as double) / 1000 as interest_rate,
  cast(600 + user_id % 900 as double) as monthly_payment,
  case when et = 'purchase' then cast((600 + user_id % 900) + (k - 50) as double) end as payment_amount,
  case when event_id % 97 = 0 then null when et = 'view' then cast(30 + 30 * (event_id % 4) as int) when et = 'error' then cast(120 + event_id % 246 as int) else 0 end as days_past_due,
  case cast(user_id % 5 as int) when 0 then 'CA' when 1 then 'TX' when 2 then 'FL' when 3 then 'NY' else 'IL' end as property_state,
  case when event_id % 89 = 0 then null else cast(560 + k * 3 as int) end as credit_score,
  cast(60 + event_id % 45 as double) / 100 as ltv_ratio,
  cast(15 + k % 40 as double) / 100 as dti_ratio,
  ts as event_timestamp,
  (event_id % 50 <> 7) as is_valid,
  ts + interval 1 hour as loaded_at
from (select event_id, user_id, ts, event_type as et, cast(json_extract_string(props, '$.k') as int) as k from events)
"""

LOAN_HISTORY = """
select
  concat('LN-S', cast(l_suppkey as varchar)) as loan_id,
  cast(l_shipdate as date) as event_date,
  l_orderkey as tie1, l_linenumber as tie2, l_partkey as tie3,
  case l_returnflag when 'R' then 30 * (1 + l_linenumber % 4) else 0 end as days_past_due,
  case l_returnflag when 'A' then l_quantity end as payment_amount,
  cast(25 as double) as monthly_payment
from lineitem
"""

STG = f"""
select
  event_id, loan_id, borrower_id, tenant_id,
  upper(trim(event_type)) as event_type,
  upper(trim(loan_type)) as loan_type,
  upper(trim(loan_purpose)) as loan_purpose,
  try_cast(origination_date as date) as origination_date,
  try_cast(maturity_date as date) as maturity_date,
  cast(date_diff('month', origination_date, maturity_date) as integer) as loan_term_months,
  cast(date_diff('year', origination_date, {AS_OF_DATE}) as integer) as loan_age_years,
  {rnd('original_balance', 2)} as original_balance,
  {rnd('current_balance', 2)} as current_balance,
  {rnd('original_balance - current_balance', 2)} as principal_paid,
  {rnd('(original_balance - current_balance) / nullif(original_balance, 0)', 4)} as pct_principal_paid,
  {rnd('interest_rate', 6)} as interest_rate,
  {rnd('interest_rate * 100', 4)} as interest_rate_pct,
  {rnd('monthly_payment', 2)} as monthly_payment,
  {rnd('payment_amount', 2)} as payment_amount,
  coalesce(days_past_due, 0) as days_past_due,
  case when days_past_due = 0 then 'CURRENT' when days_past_due <= 30 then '30_DPD'
       when days_past_due <= 60 then '60_DPD' when days_past_due <= 90 then '90_DPD'
       when days_past_due <= 120 then '120_DPD' else 'SEVERE_DELINQUENCY' end as delinquency_bucket,
  days_past_due > 90 as is_seriously_delinquent,
  property_state, credit_score,
  case when credit_score >= 750 then 'EXCELLENT' when credit_score >= 700 then 'GOOD'
       when credit_score >= 650 then 'FAIR' when credit_score >= 600 then 'POOR' else 'VERY_POOR' end as credit_tier,
  {rnd('ltv_ratio', 4)} as ltv_ratio,
  {rnd('ltv_ratio * 100', 2)} as ltv_pct,
  ltv_ratio > 0.80 as is_high_ltv,
  {rnd('dti_ratio', 4)} as dti_ratio,
  {rnd('dti_ratio * 100', 2)} as dti_pct,
  dti_ratio > 0.43 as is_high_dti,
  is_valid,
  case when event_id is null then false when loan_id is null then false when borrower_id is null then false
       when original_balance <= 0 then false when interest_rate <= 0 then false
       when origination_date is null then false else true end as is_complete_record,
  event_timestamp,
  cast(event_timestamp as date) as event_date,
  date_trunc('month', event_timestamp) as event_month,
  loaded_at
from loan_events
where is_valid = true
"""

BASE = f"with loan_events as ({LOAN_EVENTS}), stg as ({STG})"

ORD = "event_date, event_timestamp, event_id"
PAY = "event_type = 'PAYMENT'"
RISK = rnd("cast(credit_score as double) / 850.0 * 40 + (case when ltv_ratio < 0.80 then 30 else 10 end)"
           " + (case when dti_ratio < 0.36 then 20 else 5 end) + (case when days_past_due = 0 then 10 else 0 end)", 2)

WINDOWED = f"""
w as (
  select *,
    max(days_past_due) over (partition by loan_id order by {ORD} rows between 30 preceding and current row) as max_dpd_30d,
    max(days_past_due) over (partition by loan_id order by {ORD} rows between 90 preceding and current row) as max_dpd_90d,
    days_past_due - lag(days_past_due, 1, 0) over (partition by loan_id order by {ORD}) as dpd_delta,
    count(case when days_past_due > 0 then 1 end) over (partition by loan_id order by {ORD} rows between 365 preceding and current row) as delinquency_count_12m,
    sum(coalesce(payment_amount, 0)) over (partition by loan_id, {PAY} order by event_date) as cum_pay,
    count(case when payment_amount >= monthly_payment then 1 end) over (partition by loan_id, {PAY} order by {ORD} rows between 12 preceding and current row) as on_time
  from stg)
"""

FACT = f"""{BASE}, {WINDOWED}
select event_id, loan_id, borrower_id, tenant_id, event_date, event_month, event_timestamp,
  loan_type, loan_purpose, origination_date, maturity_date, loan_term_months, loan_age_years, property_state,
  original_balance, current_balance, principal_paid, pct_principal_paid, interest_rate, interest_rate_pct,
  monthly_payment, payment_amount, credit_score, credit_tier, ltv_ratio, ltv_pct, is_high_ltv, dti_ratio, dti_pct,
  is_high_dti, days_past_due, delinquency_bucket, is_seriously_delinquent, max_dpd_30d, max_dpd_90d, dpd_delta,
  delinquency_count_12m,
  case when {PAY} then {rnd('payment_amount / nullif(monthly_payment, 0)', 4)} end as payment_ratio,
  case when {PAY} then payment_amount >= monthly_payment end as is_full_payment,
  case when {PAY} then payment_amount > monthly_payment end as is_overpayment,
  case when {PAY} then payment_amount < monthly_payment and payment_amount > 0 end as is_partial_payment,
  case when {PAY} then cum_pay end as cumulative_payments,
  case when {PAY} then on_time end as on_time_payments_12m,
  {RISK} as composite_risk_score,
  is_valid, is_complete_record, loaded_at, {RUN_TS} as dbt_updated_at
from w where is_complete_record = true
"""

FACT_DAILY = f"""{BASE}, {WINDOWED},
ranked as (
  select *, row_number() over (partition by loan_id, event_date order by event_timestamp desc, event_id desc) as rn_all
  from w),
dw as (select loan_id, event_date, max_dpd_30d, max_dpd_90d, delinquency_count_12m, dpd_delta from ranked where rn_all = 1),
pr as (
  select *, row_number() over (partition by loan_id, event_date order by event_timestamp desc, event_id desc) as rn_pay
  from w where {PAY}),
pm as (
  select loan_id, event_date, count(*) as day_payment_count, sum(payment_amount) as day_paid,
    max(cum_pay) as cumulative_payments, max(case when rn_pay = 1 then on_time end) as on_time_payments_12m,
    any_value({rnd('payment_amount / nullif(monthly_payment, 0)', 4)}) filter (where rn_pay = 1) as payment_ratio,
    any_value(payment_amount >= monthly_payment) filter (where rn_pay = 1) as is_full_payment,
    any_value(payment_amount > monthly_payment) filter (where rn_pay = 1) as is_overpayment,
    any_value(payment_amount < monthly_payment and payment_amount > 0) filter (where rn_pay = 1) as is_partial_payment
  from pr group by loan_id, event_date)
select sl.event_id, sl.loan_id, sl.borrower_id, sl.tenant_id, sl.event_type, sl.loan_type, sl.loan_purpose,
  sl.origination_date, sl.maturity_date, sl.loan_term_months, sl.loan_age_years, sl.original_balance,
  sl.current_balance, sl.principal_paid, sl.pct_principal_paid, sl.interest_rate, sl.interest_rate_pct,
  sl.monthly_payment, sl.payment_amount, sl.days_past_due, sl.delinquency_bucket, sl.is_seriously_delinquent,
  sl.property_state, sl.credit_score, sl.credit_tier, sl.ltv_ratio, sl.ltv_pct, sl.is_high_ltv, sl.dti_ratio,
  sl.dti_pct, sl.is_high_dti, sl.is_valid, sl.is_complete_record, sl.event_timestamp, sl.event_date,
  sl.event_month, sl.loaded_at,
  dw.max_dpd_30d, dw.max_dpd_90d, dw.dpd_delta, dw.delinquency_count_12m,
  pm.day_payment_count, pm.day_paid, pm.payment_ratio, pm.is_full_payment, pm.is_overpayment, pm.is_partial_payment,
  pm.cumulative_payments, pm.on_time_payments_12m,
  {rnd("cast(sl.credit_score as double) / 850.0 * 40 + (case when sl.ltv_ratio < 0.80 then 30 else 10 end) + (case when sl.dti_ratio < 0.36 then 20 else 5 end) + (case when sl.days_past_due = 0 then 10 else 0 end)", 2)} as composite_risk_score,
  {RUN_TS} as dbt_updated_at
from stg sl
left join dw on sl.loan_id = dw.loan_id and sl.event_date = dw.event_date
left join pm on sl.loan_id = pm.loan_id and sl.event_date = pm.event_date
where sl.is_complete_record = true
"""


def stg_select(columns: list[str], where: str | None = None) -> str:
    return f"{BASE} select {', '.join(columns)} from stg" + (f" where {where}" if where else "")


ORACLE: dict[str, str] = {}

ORACLE["stage_loans"] = f"{BASE} select * from stg"
ORACLE["loan_portfolio"] = FACT
ORACLE["loan_portfolio_daily"] = FACT_DAILY

ORACLE["stg_payments"] = f"""{BASE}
select event_id, loan_id, tenant_id, event_date, event_month, payment_amount, monthly_payment,
  {rnd('payment_amount / nullif(monthly_payment, 0)', 4)} as payment_ratio,
  payment_amount >= monthly_payment as is_full_payment,
  payment_amount > monthly_payment as is_overpayment,
  payment_amount < monthly_payment and payment_amount > 0 as is_partial_payment
from stg where {PAY}"""

ORACLE["stg_delinquency"] = stg_select(
    ["event_id", "loan_id", "tenant_id", "event_date", "days_past_due", "delinquency_bucket",
     "is_seriously_delinquent", "current_balance", "credit_tier"], "days_past_due > 0")

ORACLE["loan_metrics_latest"] = f"""{BASE},
r as (select *, row_number() over (partition by loan_id order by event_timestamp desc, event_id desc) as rn from stg),
a as (select loan_id, count(*) as event_count, min(event_timestamp) as first_event_at,
        max(days_past_due) as max_days_past_due, sum(payment_amount) as total_paid from stg group by loan_id)
select r.loan_id, r.event_timestamp as last_event_at, r.event_id as last_event_id, r.event_type as last_event_type,
  r.current_balance, r.days_past_due, r.delinquency_bucket, r.credit_score,
  a.event_count, a.first_event_at, a.max_days_past_due, a.total_paid
from r join a on r.loan_id = a.loan_id where r.rn = 1"""

ORACLE["payment_agg_monthly"] = f"""{BASE}
select loan_id, event_month, count(*) as payment_count, sum(payment_amount) as total_paid,
  sum(monthly_payment) as total_due, count(case when payment_amount >= monthly_payment then 1 end) as full_payment_count,
  count(case when payment_amount >= monthly_payment then 1 end) / count(*) as full_payment_rate
from stg where {PAY} group by loan_id, event_month"""

ORACLE["delinquency_dashboard"] = f"""{BASE}
select tenant_id, property_state, delinquency_bucket, count(*) as event_count, count(distinct loan_id) as loan_count,
  sum(current_balance) as total_current_balance,
  count(case when is_seriously_delinquent then 1 end) as serious_count,
  count(case when is_seriously_delinquent then 1 end) / count(*) as serious_share
from stg group by tenant_id, property_state, delinquency_bucket"""

ORACLE["dim_loan_attributes"] = f"""{BASE},
r as (select *, row_number() over (partition by loan_id order by event_timestamp desc, event_id desc) as rn from stg)
select loan_id, borrower_id, tenant_id, loan_type, loan_purpose, origination_date, maturity_date, loan_term_months,
  property_state, original_balance, interest_rate, event_timestamp as attributes_as_of, event_id as latest_event_id
from r where rn = 1"""

ORACLE["executive_portfolio"] = f"""with fact as ({FACT})
select tenant_id, event_month, count(distinct loan_id) as active_loans, count(*) as event_count,
  sum(current_balance) as total_current_balance, avg(credit_score) as avg_credit_score,
  sum(cast(round(composite_risk_score * 100) as bigint)) / count(composite_risk_score) / 100 as avg_risk_score
from fact group by tenant_id, event_month"""

HIST = f"with h as ({LOAN_HISTORY})"
HORD = "partition by loan_id order by event_date, tie1, tie2, tie3"
HK = "loan_id, event_date, tie1, tie2, tie3"

ORACLE["rolling_max_dpd"] = f"""{HIST}
select {HK}, days_past_due,
  max(days_past_due) over ({HORD} rows between 30 preceding and current row) as max_dpd_30d,
  max(days_past_due) over ({HORD} rows between 90 preceding and current row) as max_dpd_90d
from h"""

ORACLE["dpd_delta"] = f"""{HIST}
select {HK}, days_past_due, days_past_due - lag(days_past_due, 1, 0) over ({HORD}) as dpd_delta from h"""

ORACLE["delinquency_count"] = f"""{HIST}
select {HK}, days_past_due,
  count(case when days_past_due > 0 then 1 end) over ({HORD} rows between 365 preceding and current row) as delinquency_count_12m
from h"""

ORACLE["payment_windows"] = f"""{HIST}
select {HK}, payment_amount,
  sum(coalesce(payment_amount, 0)) over (partition by loan_id order by event_date) as cumulative_payments,
  count(case when payment_amount >= monthly_payment then 1 end) over ({HORD} rows between 12 preceding and current row) as on_time_payments_12m
from h where payment_amount is not null"""

ORACLE["rolling_max_dpd_calendar"] = f"""{HIST}
select {HK}, days_past_due,
  max(days_past_due) over (partition by loan_id order by event_date range between interval 30 days preceding and current row) as max_dpd_30d,
  max(days_past_due) over (partition by loan_id order by event_date range between interval 90 days preceding and current row) as max_dpd_90d,
  count(case when days_past_due > 0 then 1 end) over (partition by loan_id order by event_date range between interval 365 days preceding and current row) as delinquency_count_365d
from h"""

ORACLE["rolling_max_dpd_split"] = f"""{HIST}
select {HK}, days_past_due,
  max(days_past_due) over ({HORD} rows between 30 preceding and current row) as max_dpd_30d,
  max(days_past_due) over ({HORD} rows between 90 preceding and current row) as max_dpd_90d,
  days_past_due - lag(days_past_due, 1, 0) over ({HORD}) as dpd_delta,
  count(case when days_past_due > 0 then 1 end) over ({HORD} rows between 365 preceding and current row) as delinquency_count_12m
from h"""

ORACLE["loan_portfolio_split"] = FACT

# ---------------------------------------------------------------------------
# Staging projections and scalar formulas
# ---------------------------------------------------------------------------
_STAGING_VIEWS = {
    "delinquency_bucket": "event_id, days_past_due, delinquency_bucket, is_seriously_delinquent",
    "credit_tier": "event_id, credit_score, credit_tier",
    "ltv_dti_flags": "event_id, ltv_ratio, ltv_pct, is_high_ltv, dti_ratio, dti_pct, is_high_dti",
    "loan_term_age": "event_id, origination_date, maturity_date, loan_term_months, loan_age_years",
    "principal_paid": "event_id, original_balance, current_balance, principal_paid, pct_principal_paid, "
                      "interest_rate, interest_rate_pct",
    "complete_record": "event_id, loan_id, borrower_id, is_complete_record",
    "event_calendar": "event_id, event_type, loan_type, loan_purpose, event_timestamp, event_date, event_month",
}
for _n, _c in _STAGING_VIEWS.items():
    ORACLE[_n] = f"{BASE} select {_c} from stg"

ORACLE["risk_score"] = f"{BASE} select event_id, {RISK} as composite_risk_score from stg"

_R = "(interest_rate / 12.0)"
_G = f"pow(1.0 + {_R}, cast(loan_term_months as double))"
ORACLE["amortised_payment"] = f"""{BASE}
select event_id, {rnd(f"case when {_R} = 0 then original_balance / cast(loan_term_months as double) else original_balance * ({_R} * {_G}) / ({_G} - 1.0) end", 2)} as level_payment
from stg"""

ORACLE["remaining_balance"] = f"""{BASE}
select event_id, {rnd("original_balance * (1.0 - cast((year(event_date) - year(origination_date)) * 12 + month(event_date) - month(origination_date) as integer) / cast(loan_term_months as double))", 2)} as linear_balance
from stg"""

ORACLE["maturity_date"] = f"""{BASE}
select event_id, origination_date + cast(loan_term_months * 30 as integer) as maturity_30d from stg"""

ORACLE["clamp_score"] = f"""with le as ({LOAN_EVENTS})
select event_id, greatest(300, least(850, credit_score)) as credit_score_clamped from le"""

# ---------------------------------------------------------------------------
# Ingestion
# ---------------------------------------------------------------------------
LE = f"with le as ({LOAN_EVENTS})"
CUT = "timestamp '2024-01-15 12:00:00'"
EVENT_COLS = ("event_id, loan_id, borrower_id, tenant_id, event_type, loan_type, loan_purpose, origination_date, "
              "maturity_date, original_balance, current_balance, interest_rate, monthly_payment, payment_amount, "
              "days_past_due, property_state, credit_score, ltv_ratio, dti_ratio, event_timestamp, is_valid")

ORACLE["event_json_roundtrip"] = f"{LE} select {EVENT_COLS} from le where borrower_id is not null"
ORACLE["quarantine_rejects"] = f"{LE} select event_id, 'not_null:borrower_id' as reason from le where borrower_id is null"

ORACLE["merge_insert_new_events"] = f"""{LE}
select * from le a where not exists (select 1 from le b where b.loaded_at < {CUT} and b.event_id = a.event_id)"""

ORACLE["merge_insert_by_key_index"] = ORACLE["merge_insert_new_events"]

FILES = """select concat('ds=', cast(cast(event_timestamp as date) as varchar), '/', tenant_id) as file,
  cast(sum(octet_length(encode(event_id)) + octet_length(encode(loan_id))) as bigint) as length, max(loaded_at) as modified
from le {} group by 1"""
ORACLE["unloaded_files"] = f"""{LE}, found as ({FILES.format("")}), history as ({FILES.format(f"where loaded_at < {CUT}")})
select * from found f where not exists (
  select 1 from history h where h.file is not distinct from f.file and h.length = f.length and h.modified = f.modified)"""

REPLAYED = f"""replayed as (
  select * from le
  union all
  select event_id, loan_id, borrower_id, tenant_id, event_type, loan_type, loan_purpose, origination_date,
    maturity_date, original_balance, current_balance - 1.0 as current_balance, interest_rate, monthly_payment,
    payment_amount, days_past_due, property_state, credit_score, ltv_ratio, dti_ratio, event_timestamp, is_valid,
    loaded_at + interval 1 day as loaded_at
  from le where loaded_at >= {CUT})"""

ORACLE["dedup_latest_event"] = f"""{LE}, {REPLAYED},
r as (select *, row_number() over (partition by event_id order by event_timestamp desc, loaded_at desc) as rn from replayed)
select * exclude (rn) from r where rn = 1"""

ORACLE["load_counts"] = f"""{LE}, {REPLAYED}
select (select count(*) from replayed) as batch_rows,
  (select count(*) from le where loaded_at >= {CUT}) as rows_inserted,
  (select count(*) from replayed) - (select count(*) from le where loaded_at >= {CUT}) as rows_skipped"""

# ---------------------------------------------------------------------------
# Load report
# ---------------------------------------------------------------------------
_STATS = """select date_trunc('hour', loaded_at) as load_hour, event_type, tenant_id, count(*) as event_count,
  avg(original_balance) as avg_balance, sum(original_balance) as total_balance,
  avg(credit_score) as avg_credit_score, avg(days_past_due) as avg_dpd
from le {where} group by 1, 2, 3 order by 1 desc, 4 desc"""
ORACLE["load_stats_24h"] = f"{LE} " + _STATS.format(where=f"where loaded_at >= {AS_OF_TS} - interval 24 hour")
ORACLE["load_stats_hourly"] = f"{LE} " + _STATS.format(where="")

# ---------------------------------------------------------------------------
# Incremental
# ---------------------------------------------------------------------------
ORACLE["incremental_new_rows"] = f"""{BASE}
select * from stg
where event_date > (select max(event_date) from stg where loaded_at < {CUT} and is_complete_record)"""

ORACLE["incremental_fact_refresh"] = FACT

ORACLE["upsert_latest_per_loan"] = f"""{BASE},
r as (select loan_id, event_timestamp, event_id, current_balance, days_past_due, delinquency_bucket,
        row_number() over (partition by loan_id order by event_timestamp desc, event_id desc) as rn from stg)
select loan_id, event_timestamp, event_id, current_balance, days_past_due, delinquency_bucket from r where rn = 1"""

# ---------------------------------------------------------------------------
# Quality, history, masking
# ---------------------------------------------------------------------------
_LIMITS = {"event_id": 36, "loan_id": 20, "borrower_id": 20, "tenant_id": 50, "event_type": 20,
           "loan_type": 20, "loan_purpose": 20, "property_state": 2}
ORACLE["check_varchar_lengths"] = f"{LE} " + " union all ".join(
    f"select '{c}' as column_name, count(case when length({c}) > {n} then 1 end) as violations from le"
    for c, n in _LIMITS.items())

_RAW_COLS = [c.strip() for c in EVENT_COLS.split(",")] + ["loaded_at"]
ORACLE["check_nulls"] = f"{LE} " + " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as null_count from le" for c in _RAW_COLS)

_RANGES = {
    "credit_score_300_850": "not (credit_score between 300 and 850)",
    "days_past_due_non_negative": "days_past_due < 0",
    "ltv_ratio_non_negative": "ltv_ratio < 0",
    "dti_ratio_non_negative": "dti_ratio < 0",
    "original_balance_positive": "original_balance <= 0",
    "interest_rate_positive": "interest_rate <= 0",
    "current_balance_non_negative": "current_balance < 0",
}
ORACLE["check_ranges"] = f"{LE} " + " union all ".join(
    f"select '{n}' as rule, count(case when {c} then 1 end) as violations from le" for n, c in _RANGES.items())

_RELS = [
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
]
ORACLE["check_relationships"] = " union all ".join(
    f"""select '{n}' as relationship, (select count(*) from {c} where {ck} is not null) as child_rows,
  (select count(*) from {c} where {ck} is not null and {ck} not in (select {pk} from {p} where {pk} is not null)) as orphan_rows,
  (select count(distinct {ck}) from {c} where {ck} is not null and {ck} not in (select {pk} from {p} where {pk} is not null)) as orphan_keys"""
    for n, c, ck, p, pk in _RELS)


def _uniq(name: str, src: str, keys: str) -> str:
    return f"""select '{name}' as check_name, count(*) as distinct_keys, count(case when n > 1 then 1 end) as duplicate_keys,
  cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows from (select {keys}, count(*) as n from {src} group by {keys})"""


ORACLE["check_unique"] = f"{LE} " + " union all ".join([
    _uniq("lineitem(l_orderkey,l_linenumber)", "lineitem", "l_orderkey, l_linenumber"),
    _uniq("orders(o_orderkey)", "orders", "o_orderkey"),
    _uniq("loan_events(event_id)", "le", "event_id")])

ORACLE["unique_violations"] = """select l_orderkey, l_linenumber, count(*) as n from lineitem
group by l_orderkey, l_linenumber having count(*) > 1"""

_DOMAINS = {
    "event_type": ["ORIGINATION", "PAYMENT", "PREPAYMENT", "DELINQUENCY", "DEFAULT"],
    "loan_type": ["CONVENTIONAL", "FHA", "VA", "JUMBO", "ARM"],
    "loan_purpose": ["PURCHASE", "REFINANCE", "CASH_OUT_REFI"],
    "property_state": ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI"],
    "tenant_id": ["mortgage_servicer_a", "mortgage_servicer_b", "mortgage_servicer_c"],
}
ORACLE["check_accepted_values"] = f"{LE} " + " union all ".join(
    f"select '{c}' as column_name, {c} as value, count(*) as rows from le "
    f"where {c} not in ({', '.join(repr(v) for v in vals)}) group by {c}"
    for c, vals in _DOMAINS.items())

ORACLE["freshness"] = f"""{LE}
select tenant_id, max(loaded_at) as last_loaded_at,
  cast(floor((epoch_us({AS_OF_TS}) - epoch_us(max(loaded_at))) / 1000000) as bigint) as age_seconds,
  (epoch_us({AS_OF_TS}) - epoch_us(max(loaded_at))) > 15 * 60 * 1000000 as is_stale
from le group by tenant_id"""

ORACLE["volume_anomaly"] = f"""{LE},
h as (select tenant_id, date_trunc('hour', loaded_at) as load_hour, count(*) as event_count from le group by 1, 2),
s as (select *,
  count(event_count) over w as k, sum(event_count) over w as s1, sum(event_count * event_count) over w as s2
  from h window w as (partition by tenant_id order by cast(floor(epoch(load_hour) / 3600) as bigint)
                      range between 24 preceding and 1 preceding)),
z as (select *, cast(s1 as double) / cast(k as double) as mean,
  cast(k * s2 - s1 * s1 as double) / cast(k * (k - 1) as double) as var from s)
select tenant_id, load_hour, event_count, k as trailing_hours_seen,
  case when k > 0 then mean end as trailing_mean,
  case when k >= 2 and var > 0 then (cast(event_count as double) - mean) / sqrt(var) end as z_score,
  coalesce(abs(case when k >= 2 and var > 0 then (cast(event_count as double) - mean) / sqrt(var) end) > 3.0, false) as is_anomaly
from z"""

ORACLE["scd2_history"] = f"""{BASE},
m as (select *, lag(delinquency_bucket) over w as pb, lag(credit_tier) over w as pt,
        row_number() over w as rn
      from stg window w as (partition by loan_id order by event_timestamp, event_id)),
st as (select loan_id, event_id, event_timestamp as valid_from, delinquency_bucket, credit_tier from m
       where rn = 1 or pb is distinct from delinquency_bucket or pt is distinct from credit_tier)
select loan_id, delinquency_bucket, credit_tier, valid_from,
  lead(valid_from) over (partition by loan_id order by valid_from, event_id) as valid_to,
  lead(valid_from) over (partition by loan_id order by valid_from, event_id) is null as is_current
from st"""

for _mart in ("payment_agg_monthly", "delinquency_dashboard", "executive_portfolio"):
    ORACLE[f"{_mart}_refresh"] = ORACLE[_mart]
ORACLE["history_merge"] = ORACLE["scd2_history"]
ORACLE["masked_borrowers"] = f"""{LE}
select event_id, loan_id, sha256(borrower_id) as borrower_id_hash,
  substr(borrower_id, 1, 4) || repeat('*', greatest(length(borrower_id) - 4, 0)) as borrower_id_masked
from le"""

ORACLE["loan_portfolio_daily_split"] = FACT_DAILY

ORACLE["rolling_max_dpd_calendar_split"] = ORACLE["rolling_max_dpd_calendar"]

ORACLE["incremental_partition_refresh"] = f"""with fact as ({FACT}),
loan_events as ({LOAN_EVENTS}), stg as ({STG}),
since as (select max(loaded_at) as m from stg where loaded_at < {CUT} and is_complete_record),
fresh as (select loan_id, min(event_date) as d0 from stg where loaded_at > (select m from since) group by loan_id),
touched as (select distinct f.event_date from fact f join fresh r on f.loan_id = r.loan_id where f.event_date >= r.d0)
select * from fact where event_date in (select event_date from touched)"""

ORACLE["json_extract_cast"] = f"{LE} select {EVENT_COLS} from le"

ORACLE["payment_flags"] = f"""{BASE}
select event_id, payment_amount, monthly_payment,
  {rnd('payment_amount / nullif(monthly_payment, 0)', 4)} as payment_ratio,
  payment_amount >= monthly_payment as is_full_payment,
  payment_amount > monthly_payment as is_overpayment,
  payment_amount < monthly_payment and payment_amount > 0 as is_partial_payment
from stg"""

ORACLE["dimension_merge"] = ORACLE["dim_loan_attributes"]

ORACLE["incremental_state_refresh"] = FACT
ORACLE["schema_sync_refresh"] = ORACLE["schema_sync_state_refresh"] = FACT.replace(
    "as dbt_updated_at", f"as dbt_updated_at, case when loaded_at >= {CUT} then lower(event_type) end as channel")

# Message encoding (A1, B5): key = tenant, value = the 21 event fields as a
# compact JSON object, nulls written, timestamp as ISO text with microseconds.
_JSON_FIELDS = ", ".join(
    f"'{c}': strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f')" if c == "event_timestamp"
    else f"'{c}': cast({c} as varchar)" if c in ("origination_date", "maturity_date")
    else f"'{c}': {c}"
    for c in [x.strip() for x in EVENT_COLS.split(",")])
ORACLE["publish_records"] = f"{LE} select tenant_id as key, to_json({{{_JSON_FIELDS}}}) as value from le"

ORACLE["portfolio_by_bucket_sql"] = f"""with fact as ({FACT}),
pay as ({BASE} select event_id from stg where {PAY})
select f.tenant_id, f.delinquency_bucket, count(distinct f.loan_id) as loans, max(f.max_dpd_90d) as worst_dpd,
  count(p.event_id) as payments
from fact f left join pay p on f.event_id = p.event_id group by 1, 2"""

# ---------------------------------------------------------------------------
# NULL keys and dates (first in every order), money as decimal cents
# ---------------------------------------------------------------------------
ORACLE["payment_windows_cents"] = """
with h as (
  select case when l_suppkey % 7 <> 0 then concat('LN-S', cast(l_suppkey as varchar)) end as loan_id,
    case when l_orderkey % 61 <> 0 then cast(l_shipdate as date) end as event_date,
    l_orderkey as tie1, l_linenumber as tie2, cast(cast(l_extendedprice as decimal(18,2)) as double) as payment_amount
  from lineitem)
select loan_id, event_date, tie1, tie2, payment_amount,
  cast(sum(cast(payment_amount as decimal(18,2))) over (partition by loan_id order by event_date nulls first) as double)
    as cumulative_payments,
  count(case when payment_amount >= 25000 then 1 end) over (partition by loan_id
    order by event_date nulls first, tie1, tie2, payment_amount rows between 12 preceding and current row) as on_time_payments_12m
from h"""
ORACLE["payment_windows_cents_split"] = ORACLE["payment_windows_cents"]

_UNDATED = FACT
for _old, _new in (("  ts as event_timestamp", "  case when event_id % 61 <> 0 then ts end as event_timestamp"),
                   (f"order by {ORD}", "order by event_date nulls first, event_timestamp nulls first, event_id"),
                   ("order by event_date) as cum_pay", "order by event_date nulls first) as cum_pay")):
    _UNDATED = _UNDATED.replace(_old, _new)
ORACLE["incremental_undated_refresh"] = _UNDATED
ORACLE["incremental_undated_state"] = _UNDATED

# ---------------------------------------------------------------------------
# Names, audit columns, replays, sharper checks
# ---------------------------------------------------------------------------
ORACLE["upper_case_names"] = f"""{BASE}
select event_id as "EVENT_ID", loan_id as "LOAN_ID", delinquency_bucket as "DELINQUENCY_BUCKET" from stg"""
ORACLE["raw_audit_columns"] = f"""{LE}
select {EVENT_COLS.replace('days_past_due', '0 as days_past_due')}, {AS_OF_TS} as loaded_at, 'batch-1' as batch_id from le"""
ORACLE["replayed_merge"] = f"""{LE}
select count(*) as batch_rows, cast(0 as bigint) as rows_inserted, count(*) as rows_skipped from le"""
ORACLE["empty_batch_counts"] = """select cast(0 as bigint) as batch_rows, cast(0 as bigint) as rows_inserted,
  cast(0 as bigint) as rows_skipped"""
ORACLE["check_orphans"] = """select 'orders.o_custkey->customer' as relationship, count(*) as child_rows,
  count(case when o_custkey not in (select c_custkey from customer where c_custkey % 7 <> 0) then 1 end) as orphan_rows,
  count(distinct case when o_custkey not in (select c_custkey from customer where c_custkey % 7 <> 0) then o_custkey end) as orphan_keys
from orders where o_custkey is not null"""
ORACLE["freshness_stale"] = ORACLE["freshness"].replace(AS_OF_TS, "timestamp '2024-03-31 00:00:00'")
