"""Hourly load report over the raw table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions.columns import ts_ntz_lit


def hourly_load_stats(raw: DataFrame, as_of: dt.datetime | None = None, hours: int = 24) -> DataFrame:
    """Rows loaded per hour x event_type x tenant with balance, credit-score
    and days-past-due figures. With ``as_of`` only the last ``hours`` hours
    of loads count (``loaded_at >= as_of - hours``). Sorted by hour desc,
    count desc. The grouping keys are few (hours x types x tenants), and
    partial aggregation reduces every task's rows before the shuffle."""
    df = raw
    if as_of is not None:
        df = df.filter(F.col("loaded_at") >= ts_ntz_lit(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS"))
    return (df.groupBy(F.date_trunc("hour", "loaded_at").cast("timestamp_ntz").alias("load_hour"),
                       "event_type", "tenant_id")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.avg("original_balance").alias("avg_balance"),
                 F.sum("original_balance").alias("total_balance"),
                 F.avg("credit_score").alias("avg_credit_score"),
                 F.avg("days_past_due").alias("avg_dpd"))
            .orderBy(F.col("load_hour").desc(), F.col("event_count").desc()))
