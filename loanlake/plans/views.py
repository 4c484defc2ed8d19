"""Logical table names for SQL users.

Models are Python functions over DataFrames; ``register_models`` exposes
them as temporary views so existing SQL keeps working against the same names:
``raw_loan_events``, ``stg_loans`` (a view: recomputed lazily per query),
``fct_loan_portfolio`` and the declared models. A fact written by the
pipeline can be registered instead of the lazy one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from loanlake.operators import marts, staging
from loanlake.operators.staging import DEFAULT_AS_OF


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name (B2); Spark resolves names
    case-insensitively, so either spelling works downstream."""
    return df.toDF(*[c.upper() for c in df.columns])


def register_models(spark: SparkSession, raw: DataFrame, as_of: dt.datetime = DEFAULT_AS_OF,
                    fact: DataFrame | None = None, build_fact: bool = True) -> dict[str, DataFrame]:
    """Register the model views. Building the lazy fact runs its hot-key check,
    a scan of the raw table with one combinable shuffle; pass a written
    ``fact`` or ``build_fact=False`` to skip it. The executive view needs no
    window and reads the fact's base rows."""
    stg = staging.stage_loans(raw, as_of)
    fct = fact if fact is not None else (marts.loan_portfolio(stg) if build_fact else None)
    models = {
        "raw_loan_events": raw,
        "stg_loans": stg,
        "stg_payments": marts.stg_payments(stg),
        "stg_delinquency": marts.stg_delinquency(stg),
        "int_loan_metrics": marts.loan_metrics_latest(stg),
        "int_payment_agg": marts.payment_agg_monthly(stg),
        "fct_delinquency_dashboard": marts.delinquency_dashboard(stg),
        "dim_loan_attributes": marts.dim_loan_attributes(stg),
    }
    if fct is not None:
        models["fct_loan_portfolio"] = fct
        models["executive_portfolio"] = marts.executive_portfolio(fact if fact is not None else marts.fact_base(stg))
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return models
