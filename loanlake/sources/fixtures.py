"""Adapters that derive loan-shaped tables from the driver's parquet tables.

``loan_events`` turns every row of ``events`` into one raw loan event (one
loan per user); ``loan_history`` turns ``lineitem`` into long per-loan
delinquency histories (one loan per supplier) so 91-row, 366-row and
calendar frames are really truncated. Integer arithmetic only, so any SQL
engine derives identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_DATE = "2014-01-15"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _case_int(c: Column, values: list) -> Column:
    """CASE c WHEN 0 THEN values[0] WHEN 1 ... ELSE values[-1]."""
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(c == i, F.lit(values[i])).otherwise(out)
    return out


def _base_plus(days: Column) -> Column:
    return F.date_add(F.lit(BASE_DATE).cast("date"), days.cast("int"))


def loan_events_from(events: DataFrame) -> DataFrame:
    """Raw loan events (21 event fields + loaded_at) from an ``events`` frame."""
    e = events.select(
        "event_id", "user_id", "ts", F.col("event_type").alias("et"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    eid, uid, et, k = F.col("event_id"), F.col("user_id"), F.col("et"), F.col("k")
    orig_days = uid * 37 % 3600
    balance = F.lit(100000) + uid * 7919 % 2400000
    return e.select(
        F.concat(F.lit("EV-"), eid.cast("string")).alias("event_id"),
        F.concat(F.lit("LN-"), uid.cast("string")).alias("loan_id"),
        F.when(eid % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("BRW-"), uid.cast("string"))).alias("borrower_id"),
        _case_int((uid % 3).cast("int"),
                  ["mortgage_servicer_a", "mortgage_servicer_b", "mortgage_servicer_c"]).alias("tenant_id"),
        F.when(et == "signup", " origination").when(et == "purchase", "PAYMENT")
        .when(et == "click", "Prepayment ").when(et == "view", "DELINQUENCY")
        .otherwise("DEFAULT").alias("event_type"),
        _case_int((uid % 5).cast("int"), ["conventional", "FHA", "VA", "JUMBO", "ARM"]).alias("loan_type"),
        F.when((uid % 4).cast("int") == 0, "PURCHASE").when((uid % 4).cast("int") == 1, "REFINANCE")
        .when((uid % 4).cast("int") == 2, "CASH_OUT_REFI").alias("loan_purpose"),
        F.when(eid % 103 == 0, F.lit(None).cast("date"))
        .otherwise(_base_plus(orig_days)).alias("origination_date"),
        _base_plus(orig_days + 5400 + 1800 * (uid % 4)).alias("maturity_date"),
        F.when(eid % 107 == 0, F.lit(0.0)).otherwise(balance.cast("double")).alias("original_balance"),
        (balance - eid % 90000).cast("double").alias("current_balance"),
        ((F.lit(30) + uid % 56).cast("double") / 1000).alias("interest_rate"),
        (F.lit(600) + uid % 900).cast("double").alias("monthly_payment"),
        F.when(et == "purchase", ((F.lit(600) + uid % 900) + (k - 50)).cast("double")).alias("payment_amount"),
        F.when(eid % 97 == 0, F.lit(None).cast("int"))
        .when(et == "view", (F.lit(30) + 30 * (eid % 4)).cast("int"))
        .when(et == "error", (F.lit(120) + eid % 246).cast("int"))
        .otherwise(F.lit(0)).alias("days_past_due"),
        _case_int((uid % 5).cast("int"), ["CA", "TX", "FL", "NY", "IL"]).alias("property_state"),
        F.when(eid % 89 == 0, F.lit(None).cast("int")).otherwise((F.lit(560) + k * 3).cast("int")).alias("credit_score"),
        ((F.lit(60) + eid % 45).cast("double") / 100).alias("ltv_ratio"),
        ((F.lit(15) + k % 40).cast("double") / 100).alias("dti_ratio"),
        F.col("ts").alias("event_timestamp"),
        (eid % 50 != 7).alias("is_valid"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("loaded_at"),
    )


def loan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_events_from(read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type", "props"]))


def undated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan events, every 61st without an event timestamp."""
    number = F.substring("event_id", 4, 20).cast("long")
    return loan_events(spark, sf_dir).withColumn(
        "event_timestamp", F.when(number % 61 != 0, F.col("event_timestamp")))


def payments_in_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments in cents from ``lineitem``, some without a date or a loan."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"])
    return li.select(
        F.when(F.col("l_suppkey") % 7 != 0, F.concat(F.lit("LN-S"), F.col("l_suppkey").cast("string"))).alias("loan_id"),
        F.when(F.col("l_orderkey") % 61 != 0, F.col("l_shipdate").cast("date")).alias("event_date"),
        F.col("l_orderkey").alias("tie1"), F.col("l_linenumber").alias("tie2"),
        F.round("l_extendedprice", 2).alias("payment_amount"), F.lit(25000.0).alias("monthly_payment"))


def loan_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long per-loan histories from ``lineitem``; order key event_date, tie1..tie3."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                     "l_returnflag", "l_quantity"])
    return li.select(
        F.concat(F.lit("LN-S"), F.col("l_suppkey").cast("string")).alias("loan_id"),
        F.col("l_shipdate").cast("date").alias("event_date"),
        F.col("l_orderkey").alias("tie1"),
        F.col("l_linenumber").alias("tie2"),
        F.col("l_partkey").alias("tie3"),
        F.when(F.col("l_returnflag") == "R", 30 * (1 + F.col("l_linenumber") % 4))
        .otherwise(F.lit(0)).alias("days_past_due"),
        F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).alias("payment_amount"),
        F.lit(25.0).alias("monthly_payment"),
    )
