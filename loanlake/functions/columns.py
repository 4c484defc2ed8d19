"""Column builders for the loan model. All are plain Catalyst expressions, so
they stay inside whole-stage codegen; nothing here is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlake import schema as S


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal independent of the session and process time zones."""
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))


def clean_code(c) -> Column:
    """UPPER(TRIM(x))."""
    return F.upper(F.trim(col_(c)))


def safe_ratio(num, den) -> Column:
    """num / NULLIF(den, 0): NULL instead of an ANSI divide-by-zero error."""
    den = col_(den)
    return col_(num) / F.when(den != 0, den)


def month_boundaries(start, end) -> Column:
    """Calendar-month boundaries crossed from start to end."""
    s, e = col_(start), col_(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def year_boundaries(start, end) -> Column:
    """Calendar-year boundaries crossed from start to end."""
    return F.year(col_(end)) - F.year(col_(start))


def delinquency_bucket(dpd) -> Column:
    """D11, on the raw value: NULL falls through to SEVERE_DELINQUENCY."""
    d = col_(dpd)
    return (F.when(d == 0, "CURRENT").when(d <= 30, "30_DPD").when(d <= 60, "60_DPD")
            .when(d <= 90, "90_DPD").when(d <= 120, "120_DPD").otherwise("SEVERE_DELINQUENCY"))


def credit_tier(score) -> Column:
    """NULL falls through to VERY_POOR."""
    s = col_(score)
    return (F.when(s >= 750, "EXCELLENT").when(s >= 700, "GOOD").when(s >= 650, "FAIR")
            .when(s >= 600, "POOR").otherwise("VERY_POOR"))


def is_complete_record(event_id="event_id", loan_id="loan_id", borrower_id="borrower_id",
                       original_balance="original_balance", interest_rate="interest_rate",
                       origination_date="origination_date") -> Column:
    """FALSE on a missing key/date or a non-positive balance or rate;
    a NULL balance or rate does not make the record incomplete."""
    return (F.when(col_(event_id).isNull(), False)
            .when(col_(loan_id).isNull(), False)
            .when(col_(borrower_id).isNull(), False)
            .when(col_(original_balance) <= 0, False)
            .when(col_(interest_rate) <= 0, False)
            .when(col_(origination_date).isNull(), False)
            .otherwise(True))


def payment_ratio(paid="payment_amount", due="monthly_payment") -> Column:
    """E1."""
    return F.round(safe_ratio(paid, due), 4)


def payment_flags(paid="payment_amount", due="monthly_payment") -> dict[str, Column]:
    """Three-valued on NULL, like the SQL comparisons they mirror."""
    p, d = col_(paid), col_(due)
    return {
        "is_full_payment": p >= d,
        "is_overpayment": p > d,
        "is_partial_payment": (p < d) & (p > 0),
    }


def composite_risk_score(credit_score="credit_score", ltv="ltv_ratio", dti="dti_ratio",
                         dpd="days_past_due") -> Column:
    """Credit share of 40 points + LTV 30/10 + DTI 20/5 + current 10/0.
    NULL ltv/dti take the low branch; a NULL credit score gives NULL."""
    score = col_(credit_score).cast("double") / F.lit(float(S.CREDIT_SCORE_MAX)) * F.lit(40.0)
    total = (score
             + F.when(col_(ltv) < S.SCORE_LTV, 30).otherwise(10)
             + F.when(col_(dti) < S.SCORE_DTI, 20).otherwise(5)
             + F.when(col_(dpd) == 0, 10).otherwise(0))
    return F.round(total, 2)


def level_payment(balance, annual_rate, term_months) -> Column:
    """E5: level (amortising) monthly payment, rounded to cents."""
    b, n = col_(balance), col_(term_months).cast("double")
    r = col_(annual_rate) / 12.0
    growth = F.pow(F.lit(1.0) + r, n)
    return F.round(F.when(r == 0, b / n).otherwise(b * (r * growth) / (growth - 1.0)), 2)


def linear_remaining_balance(balance, months_elapsed, term_months) -> Column:
    """E6."""
    return F.round(col_(balance) * (F.lit(1.0) - col_(months_elapsed) / col_(term_months).cast("double")), 2)


def maturity_from_term(origination_date, term_months) -> Column:
    """30 days per month of term."""
    return F.date_add(col_(origination_date), (col_(term_months) * 30).cast("int"))


def clamp_credit_score(score) -> Column:
    """E8."""
    return F.greatest(F.lit(S.CREDIT_SCORE_MIN), F.least(F.lit(S.CREDIT_SCORE_MAX), col_(score)))
