"""Data model of loan-servicing events: event record, raw table, domains.

The raw table keeps the 21 event fields plus ``loaded_at`` and a nullable
``batch_id`` so every row can be traced to the load that wrote it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source system's definitions for results
# to agree (event record domains, column length limits, NOT NULL list,
# column defaults, thresholds).
# ---------------------------------------------------------------------------
EVENT_TYPES = ["ORIGINATION", "PAYMENT", "PREPAYMENT", "DELINQUENCY", "DEFAULT"]
LOAN_TYPES = ["CONVENTIONAL", "FHA", "VA", "JUMBO", "ARM"]
LOAN_PURPOSES = ["PURCHASE", "REFINANCE", "CASH_OUT_REFI"]
STATES = ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI"]
TENANT_IDS = ["mortgage_servicer_a", "mortgage_servicer_b", "mortgage_servicer_c"]

# VARCHAR(n) limits of the raw table.
VARCHAR_LIMITS = {
    "event_id": 36,
    "loan_id": 20,
    "borrower_id": 20,
    "tenant_id": 50,
    "event_type": 20,
    "loan_type": 20,
    "loan_purpose": 20,
    "property_state": 2,
}
NOT_NULL_COLUMNS = ["event_id", "loan_id", "borrower_id", "tenant_id", "event_type"]
# Column defaults of the raw table (loaded_at defaults to the load time).
COLUMN_DEFAULTS = {"days_past_due": 0, "is_valid": True}
CREDIT_SCORE_MIN, CREDIT_SCORE_MAX = 300, 850
HIGH_LTV, HIGH_DTI = 0.80, 0.43
SCORE_LTV, SCORE_DTI = 0.80, 0.36
# Pipeline cadence: a run every 15 minutes, end-to-end within 15 minutes.
FRESHNESS_MINUTES = 15

STRING, DOUBLE, INT = T.StringType(), T.DoubleType(), T.IntegerType()

# Event record as it travels on the bus / lands as JSON (dates and the
# timestamp are ISO strings there).
EVENT_FIELDS: list[tuple[str, T.DataType]] = [
    ("event_id", STRING),
    ("loan_id", STRING),
    ("borrower_id", STRING),
    ("tenant_id", STRING),
    ("event_type", STRING),
    ("loan_type", STRING),
    ("loan_purpose", STRING),
    ("origination_date", T.DateType()),
    ("maturity_date", T.DateType()),
    ("original_balance", DOUBLE),
    ("current_balance", DOUBLE),
    ("interest_rate", DOUBLE),
    ("monthly_payment", DOUBLE),
    ("payment_amount", DOUBLE),
    ("days_past_due", INT),
    ("property_state", STRING),
    ("credit_score", INT),
    ("ltv_ratio", DOUBLE),
    ("dti_ratio", DOUBLE),
    ("event_timestamp", T.TimestampNTZType()),
    ("is_valid", T.BooleanType()),
]
# ---------------------------------------------------------------------------
EVENT_COLUMNS = [name for name, _ in EVENT_FIELDS]

RAW_SCHEMA = T.StructType(
    [T.StructField(n, t, n not in NOT_NULL_COLUMNS) for n, t in EVENT_FIELDS]
    + [
        T.StructField("loaded_at", T.TimestampNTZType(), True),
        T.StructField("batch_id", STRING, True),
    ]
)

# Raw table laid out by event_date (partition column derived from
# event_timestamp), for date-pruned key checks.
RAW_SCHEMA_BY_DATE = T.StructType(RAW_SCHEMA.fields + [T.StructField("event_date", T.DateType(), True)])


def extra_fields(extra: tuple[tuple[str, str], ...]) -> list[tuple[str, T.DataType]]:
    """Event fields beyond the record, given as (name, DDL type)."""
    out = [(name, T.DataType.fromDDL(typ)) for name, typ in extra]
    taken = {f.name for f in RAW_SCHEMA.fields} | {"event_date"}
    clash = [n for n, _ in out if n in taken]
    if clash:
        raise ValueError(f"extra fields with names of the record: {clash}")
    return out

