"""Portfolio fact and the declared mart models.

Fact grain is one row per complete staging event. Delinquency windows run
over all valid events of a loan, payment windows over its PAYMENT events; both
are computed in place on the staging rows, so the plan needs one exchange on
``loan_id`` and no self-join. The written form that re-joins window rows on
(loan_id, event_date) multiplies same-day events (n rows -> n^2) and is not
built; ``loan_portfolio_daily`` keeps its join shape with a right side of one
row per (loan_id, event_date).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import columns as C
from loanlake.operators.windows import (DEFAULT_CHUNK_ROWS, DEFAULT_MAX_ROWS_PER_KEY, PeerAgg, Rows, RunningSum,
                                        Spec, windowed)

DEFAULT_RUN_TS = dt.datetime(2024, 1, 31, 0, 0, 0)
# Deterministic order inside a loan (event_date alone leaves ties).
EVENT_ORDER = ["event_date", "event_timestamp", "event_id"]

# The output contract of the fact (names and order).
FACT_COLUMNS = [
    "event_id", "loan_id", "borrower_id", "tenant_id", "event_date", "event_month", "event_timestamp",
    "loan_type", "loan_purpose", "origination_date", "maturity_date", "loan_term_months", "loan_age_years",
    "property_state", "original_balance", "current_balance", "principal_paid", "pct_principal_paid",
    "interest_rate", "interest_rate_pct", "monthly_payment", "payment_amount", "credit_score", "credit_tier",
    "ltv_ratio", "ltv_pct", "is_high_ltv", "dti_ratio", "dti_pct", "is_high_dti", "days_past_due",
    "delinquency_bucket", "is_seriously_delinquent", "max_dpd_30d", "max_dpd_90d", "dpd_delta",
    "delinquency_count_12m", "payment_ratio", "is_full_payment", "is_overpayment", "is_partial_payment",
    "cumulative_payments", "on_time_payments_12m", "composite_risk_score", "is_valid", "is_complete_record",
    "loaded_at", "dbt_updated_at",
]
NOT_IN_FACT = ("event_type",)


def delinquency_spec(key="loan_id", order=None, dpd="days_past_due") -> Spec:
    """Rolling max over 31 / 91 rows, change vs previous event,
    delinquent events among the last 366 rows."""
    d = F.col(dpd)
    return Spec([key], order or EVENT_ORDER, rows=[
        Rows("max_dpd_30d", "max", d, 30),
        Rows("max_dpd_90d", "max", d, 90),
        Rows("_dpd_prev", "lag", d, 1, default=0),
        Rows("delinquency_count_12m", "count", F.when(d > 0, 1), 365),
    ])


def payment_spec(keys=("loan_id", "_is_payment"), order=None, paid="payment_amount",
                 due="monthly_payment", peer="event_date") -> Spec:
    """Running paid total (same-day peers share it) and on-time
    payments among the last 13 payment rows."""
    p, d = F.col(paid), F.col(due)
    return Spec(list(keys), order or EVENT_ORDER,
                rows=[Rows("on_time_payments_12m", "count", F.when(p >= d, 1), 12)],
                running=[RunningSum("cumulative_payments", F.coalesce(p, F.lit(0.0)), peer)])


def loan_portfolio(stg: DataFrame, run_ts: dt.datetime = DEFAULT_RUN_TS,
                   max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY,
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Event-grain portfolio fact (the default mode)."""
    src = stg.withColumn("_is_payment", F.col("event_type") == "PAYMENT")
    w = windowed(src, [delinquency_spec(), payment_spec()], max_rows_per_key=max_rows_per_key,
                 chunk_rows=chunk_rows)
    return fact_select(w, stg.columns, run_ts)


def fact_select(w: DataFrame, stg_columns: list[str], run_ts: dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    """Fact columns from staging rows carrying the window outputs
    (max_dpd_30d, max_dpd_90d, _dpd_prev, delinquency_count_12m,
    cumulative_payments, on_time_payments_12m, _is_payment); C2 last.
    Staging columns beyond the contract follow it."""
    on_pay = F.col("_is_payment")
    flags = C.payment_flags()
    out = w.select(
        *stg_columns,
        "max_dpd_30d", "max_dpd_90d",
        (F.col("days_past_due") - F.col("_dpd_prev")).alias("dpd_delta"),
        "delinquency_count_12m",
        F.when(on_pay, C.payment_ratio()).alias("payment_ratio"),
        *[F.when(on_pay, e).alias(n) for n, e in flags.items()],
        F.when(on_pay, F.col("cumulative_payments")).alias("cumulative_payments"),
        F.when(on_pay, F.col("on_time_payments_12m")).alias("on_time_payments_12m"),
        C.composite_risk_score().alias("composite_risk_score"),
        C.ts_ntz_lit(run_ts).alias("dbt_updated_at"),
    ).filter(F.col("is_complete_record"))
    more = [c for c in stg_columns if c not in FACT_COLUMNS and c not in NOT_IN_FACT and not c.startswith("_")]
    return out.select(*FACT_COLUMNS, *more)


def loan_portfolio_daily(stg: DataFrame, run_ts: dt.datetime = DEFAULT_RUN_TS,
                         max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY,
                         chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """F1/F2 as many-to-one LEFT joins on (loan_id, event_date).

    Every complete event receives its loan-day's context: the delinquency
    window state after the day's last event, and the day's payment summary
    (count, amount, running total; ratio, flags and on-time count of the last
    payment).
    That is a LEFT join to one row per loan-day; it is computed as peer
    aggregates over (loan_id, event_date) - same values, no join, and for
    ordinary loans no exchange beyond the one on loan_id. Hot loans take
    combinable per-day subtotals instead, so a hot loan-day is never sent
    whole to one task.
    """
    src = stg.withColumn("_is_payment", F.col("event_type") == "PAYMENT")
    pay, day, flags = F.col("_is_payment"), "event_date", C.payment_flags()
    day_spec = Spec(["loan_id"], EVENT_ORDER, peers=[
        PeerAgg("d_max_dpd_30d", "last", F.col("max_dpd_30d"), day),
        PeerAgg("d_max_dpd_90d", "last", F.col("max_dpd_90d"), day),
        PeerAgg("d_delinquency_count_12m", "last", F.col("delinquency_count_12m"), day),
        PeerAgg("d_dpd_delta", "last", F.col("days_past_due") - F.col("_dpd_prev"), day),
        PeerAgg("day_payment_count", "count", F.when(pay, 1), day),
        PeerAgg("d_payment", "last", F.when(pay, F.struct(
            C.payment_ratio().alias("payment_ratio"), *[e.alias(n) for n, e in flags.items()])), day),
        PeerAgg("day_paid", "sum", F.when(pay, F.col("payment_amount")), day),
        PeerAgg("d_cumulative_payments", "max", F.when(pay, F.col("cumulative_payments")), day),
        PeerAgg("d_on_time_payments_12m", "last", F.when(pay, F.col("on_time_payments_12m")), day),
    ])
    w = windowed(src, [delinquency_spec(), payment_spec()], max_rows_per_key=max_rows_per_key,
                 chunk_rows=chunk_rows, then=[day_spec])
    has_pay = F.col("day_payment_count") > 0
    return w.filter(F.col("is_complete_record")).select(
        *stg.columns,
        F.col("d_max_dpd_30d").alias("max_dpd_30d"), F.col("d_max_dpd_90d").alias("max_dpd_90d"),
        F.col("d_dpd_delta").alias("dpd_delta"), F.col("d_delinquency_count_12m").alias("delinquency_count_12m"),
        F.when(has_pay, F.col("day_payment_count")).alias("day_payment_count"),
        F.when(has_pay, F.col("day_paid")).alias("day_paid"),
        *[F.col(f"d_payment.{n}").alias(n) for n in ("payment_ratio", *flags)],
        F.col("d_cumulative_payments").alias("cumulative_payments"),
        F.col("d_on_time_payments_12m").alias("on_time_payments_12m"),
        C.composite_risk_score().alias("composite_risk_score"),
        C.ts_ntz_lit(run_ts).alias("dbt_updated_at"))


# ---------------------------------------------------------------------------
# Declared models
# ---------------------------------------------------------------------------

def stg_payments(stg: DataFrame) -> DataFrame:
    """Payment events with ratio and payment flags."""
    return stg.filter(F.col("event_type") == "PAYMENT").select(
        "event_id", "loan_id", "tenant_id", "event_date", "event_month", "payment_amount",
        "monthly_payment", C.payment_ratio().alias("payment_ratio"),
        *[e.alias(n) for n, e in C.payment_flags().items()])


def stg_delinquency(stg: DataFrame) -> DataFrame:
    """Delinquent events (days past due > 0)."""
    return stg.filter(F.col("days_past_due") > 0).select(
        "event_id", "loan_id", "tenant_id", "event_date", "days_past_due", "delinquency_bucket",
        "is_seriously_delinquent", "current_balance", "credit_tier")


def loan_metrics_latest(stg: DataFrame) -> DataFrame:
    """One row per loan; the latest event's state plus lifetime counts.
    max(struct(ts, id, ...)) is a combinable aggregate: a loan with a third
    of all rows is reduced map-side before the shuffle."""
    latest = F.max(F.struct("event_timestamp", "event_id", "event_type", "current_balance",
                            "days_past_due", "delinquency_bucket", "credit_score"))
    return (stg.groupBy("loan_id").agg(
        latest.alias("l"),
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("days_past_due").alias("max_days_past_due"),
        F.sum("payment_amount").alias("total_paid"))
        .select("loan_id", F.col("l.event_timestamp").alias("last_event_at"),
                F.col("l.event_id").alias("last_event_id"), F.col("l.event_type").alias("last_event_type"),
                F.col("l.current_balance").alias("current_balance"),
                F.col("l.days_past_due").alias("days_past_due"),
                F.col("l.delinquency_bucket").alias("delinquency_bucket"),
                F.col("l.credit_score").alias("credit_score"),
                "event_count", "first_event_at", "max_days_past_due", "total_paid"))


def payment_agg_monthly(stg: DataFrame) -> DataFrame:
    """Per loan and month: payments, amounts, full-payment rate."""
    p, d = F.col("payment_amount"), F.col("monthly_payment")
    return (stg.filter(F.col("event_type") == "PAYMENT").groupBy("loan_id", "event_month").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum(p).alias("total_paid"),
        F.sum(d).alias("total_due"),
        F.count(F.when(p >= d, 1)).alias("full_payment_count"))
        .withColumn("full_payment_rate", F.col("full_payment_count") / F.col("payment_count")))


def delinquency_dashboard(stg: DataFrame) -> DataFrame:
    """Tenant x state x bucket: events, loans, balance, serious share."""
    return (stg.groupBy("tenant_id", "property_state", "delinquency_bucket").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.countDistinct("loan_id").alias("loan_count"),
        F.sum("current_balance").alias("total_current_balance"),
        F.count(F.when(F.col("is_seriously_delinquent"), 1)).alias("serious_count"))
        .withColumn("serious_share", F.col("serious_count") / F.col("event_count")))


DIM_ATTRIBUTES = ["borrower_id", "tenant_id", "loan_type", "loan_purpose", "origination_date",
                  "maturity_date", "loan_term_months", "property_state", "original_balance", "interest_rate"]


def dim_loan_attributes(stg: DataFrame) -> DataFrame:
    """Static attributes per loan, latest event (event_timestamp, then
    event_id) wins; ``attributes_as_of`` / ``latest_event_id`` name it."""
    latest = F.max(F.struct("event_timestamp", "event_id", *DIM_ATTRIBUTES)).alias("l")
    return (stg.groupBy("loan_id").agg(latest)
            .select("loan_id", *[F.col(f"l.{c}").alias(c) for c in DIM_ATTRIBUTES],
                    F.col("l.event_timestamp").alias("attributes_as_of"),
                    F.col("l.event_id").alias("latest_event_id")))


def merge_dimension(previous: DataFrame | None, stg_new: DataFrame) -> DataFrame:
    """J6 kept incrementally: the previous dimension plus the latest row per
    loan among new events; per loan the later (attributes_as_of,
    latest_event_id) wins, so a late-arriving older event never overwrites
    newer attributes. One combinable aggregate over loans, no window."""
    fresh = dim_loan_attributes(stg_new)
    if previous is None:
        return fresh
    both = previous.select(*fresh.columns).unionByName(fresh)
    rest = [c for c in fresh.columns if c not in ("loan_id", "attributes_as_of", "latest_event_id")]
    best = F.max(F.struct("attributes_as_of", "latest_event_id", *rest)).alias("b")
    return both.groupBy("loan_id").agg(best).select("loan_id", *[F.col(f"b.{c}").alias(c) for c in
                                                                 fresh.columns if c != "loan_id"]) \
        .select(*fresh.columns)


def fact_base(stg: DataFrame, run_ts: dt.datetime = DEFAULT_RUN_TS) -> DataFrame:
    """The fact's rows and window-free columns (complete events + risk
    score), for consumers that need no window metric - no window job, no
    hot-key check."""
    return stg.filter(F.col("is_complete_record")).select(
        *stg.columns, C.composite_risk_score().alias("composite_risk_score"),
        C.ts_ntz_lit(run_ts).alias("dbt_updated_at"))


def executive_portfolio(fact: DataFrame) -> DataFrame:
    """Tenant x month over the fact. The mean risk score is summed in
    whole cents so the figure does not depend on summation order."""
    cents = F.round(F.col("composite_risk_score") * 100).cast("bigint")
    return (fact.groupBy("tenant_id", "event_month").agg(
        F.countDistinct("loan_id").alias("active_loans"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum("current_balance").alias("total_current_balance"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.sum(cents).alias("_cents"), F.count(cents).alias("_n"))
        .withColumn("avg_risk_score", F.col("_cents") / F.col("_n") / 100)
        .drop("_cents", "_n"))
