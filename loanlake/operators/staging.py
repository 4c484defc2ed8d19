"""Staging model: clean and standardise raw loan events.

A lazy DataFrame -> DataFrame function (the 'view'): Catalyst inlines it into
every consumer, so the ``is_valid`` filter and the consumer's own filters and
column choices reach the parquet scan together.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake import schema as S
from loanlake.functions import columns as C

# Repeatable stand-in for CURRENT_DATE in loan age.
DEFAULT_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


def stage_loans(raw: DataFrame, as_of: dt.datetime = DEFAULT_AS_OF, extra: tuple[str, ...] = ()) -> DataFrame:
    """Raw loan events -> staging rows. Every expression reads the *raw*
    column, even where the output reuses the name (rounded vs unrounded
    flags, raw vs coalesced days past due). ``extra`` names raw columns
    beyond the record that pass through (D13)."""
    as_of_date = F.lit(as_of.date())
    dpd = F.col("days_past_due")
    ltv, dti = F.col("ltv_ratio"), F.col("dti_ratio")
    orig, curr = F.col("original_balance"), F.col("current_balance")
    return raw.filter(F.col("is_valid")).select(
        "event_id", "loan_id", "borrower_id", "tenant_id",
        C.clean_code("event_type").alias("event_type"),
        C.clean_code("loan_type").alias("loan_type"),
        C.clean_code("loan_purpose").alias("loan_purpose"),
        F.col("origination_date").try_cast("date").alias("origination_date"),
        F.col("maturity_date").try_cast("date").alias("maturity_date"),
        C.month_boundaries("origination_date", "maturity_date").alias("loan_term_months"),
        C.year_boundaries("origination_date", as_of_date).alias("loan_age_years"),
        F.round(orig, 2).alias("original_balance"),
        F.round(curr, 2).alias("current_balance"),
        F.round(orig - curr, 2).alias("principal_paid"),
        F.round(C.safe_ratio(orig - curr, orig), 4).alias("pct_principal_paid"),
        F.round("interest_rate", 6).alias("interest_rate"),
        F.round(F.col("interest_rate") * 100, 4).alias("interest_rate_pct"),
        F.round("monthly_payment", 2).alias("monthly_payment"),
        F.round("payment_amount", 2).alias("payment_amount"),
        F.coalesce(dpd, F.lit(S.COLUMN_DEFAULTS["days_past_due"])).alias("days_past_due"),
        C.delinquency_bucket(dpd).alias("delinquency_bucket"),
        (dpd > 90).alias("is_seriously_delinquent"),
        "property_state", "credit_score",
        C.credit_tier("credit_score").alias("credit_tier"),
        F.round(ltv, 4).alias("ltv_ratio"),
        F.round(ltv * 100, 2).alias("ltv_pct"),
        (ltv > S.HIGH_LTV).alias("is_high_ltv"),
        F.round(dti, 4).alias("dti_ratio"),
        F.round(dti * 100, 2).alias("dti_pct"),
        (dti > S.HIGH_DTI).alias("is_high_dti"),
        "is_valid",
        C.is_complete_record().alias("is_complete_record"),
        "event_timestamp",
        F.col("event_timestamp").cast("date").alias("event_date"),
        F.date_trunc("month", "event_timestamp").cast("timestamp_ntz").alias("event_month"),
        "loaded_at", *extra,
    )
