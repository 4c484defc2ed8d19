"""Marts kept run by run.

A mart's state has one row per group and loan with sums and counts that add up, so
new events are aggregated alone and added; an event that replaces another is added,
and the old one taken away. A loan is there while it has events, which keeps distinct
loans exact. Amounts are decimal cents: a refreshed figure equals a rebuilt one bit
for bit, in any order of batches. The mart is one aggregate over its state.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.functions import columns as C

MONEY, WHOLE = "decimal(28,2)", "bigint"


@dataclass(frozen=True)
class Mart:
    name: str
    keys: tuple[str, ...]                                     # the mart's group
    sums: dict[str, tuple[Callable[[], Column], str]]         # summed expressions and their type
    rows: Callable[[DataFrame], DataFrame]                    # the staging rows it reads
    finish: Callable[[DataFrame], DataFrame]                  # its columns from the group's sums


def _keys(mart: Mart) -> list[str]:
    return [*mart.keys, *([] if "loan_id" in mart.keys else ["loan_id"])]


def partial(stg: DataFrame, mart: Mart, sign: int = 1) -> DataFrame:
    """State rows of some staging rows; ``sign`` -1 takes them away."""
    aggs = [F.sum(F.lit(sign).cast(WHOLE)).alias("events")]
    for name, (expr, kind) in mart.sums.items():
        value = expr().cast(kind)
        aggs.append((F.coalesce(F.sum(value), F.lit(0)) * sign).cast(kind).alias(f"s_{name}"))
        aggs.append((F.count(value) * sign).alias(f"n_{name}"))
    return mart.rows(stg).groupBy(*_keys(mart)).agg(*aggs)


def add(state: DataFrame, *parts: DataFrame) -> DataFrame:
    """The state after more partial states, in any order."""
    every = state
    for p in parts:
        every = every.unionByName(p)
    values = [c for c in state.columns if c == "events" or c.startswith(("s_", "n_"))]
    keys = [c for c in state.columns if c not in values]
    out = every.groupBy(*keys).agg(*[F.sum(v).cast(state.schema[v].dataType).alias(v) for v in values])
    return out.filter("events <> 0")


def mart_rows(state: DataFrame, mart: Mart) -> DataFrame:
    """The mart from its state."""
    aggs = [F.sum("events").alias("events"), F.count(F.lit(1)).alias("loans")]
    for name in mart.sums:
        aggs += [F.sum(f"s_{name}").alias(f"s_{name}"), F.sum(f"n_{name}").alias(f"n_{name}")]
    grouped = state.groupBy(*mart.keys).agg(*aggs)
    for name, (_, kind) in mart.sums.items():
        total = F.col(f"s_{name}").cast("double" if kind == MONEY else WHOLE)
        grouped = grouped.withColumn(name, F.when(F.col(f"n_{name}") > 0, total))
    return mart.finish(grouped)


def _payments(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("event_type") == "PAYMENT")


def _complete(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("is_complete_record")).withColumn("_risk", C.composite_risk_score())


PAYMENT_AGG_MONTHLY = Mart(
    "payment_agg_monthly", ("loan_id", "event_month"), {
        "total_paid": (lambda: F.col("payment_amount"), MONEY), "total_due": (lambda: F.col("monthly_payment"), MONEY),
        "full": (lambda: F.when(F.col("payment_amount") >= F.col("monthly_payment"), 1), WHOLE)},
    _payments, lambda g: g.select(
        "loan_id", "event_month", F.col("events").alias("payment_count"), "total_paid", "total_due",
        F.col("n_full").alias("full_payment_count"), (F.col("n_full") / F.col("events")).alias("full_payment_rate")))

DELINQUENCY_DASHBOARD = Mart(
    "delinquency_dashboard", ("tenant_id", "property_state", "delinquency_bucket"), {
        "total_current_balance": (lambda: F.col("current_balance"), MONEY),
        "serious": (lambda: F.when(F.col("is_seriously_delinquent"), 1), WHOLE)},
    lambda stg: stg, lambda g: g.select(
        "tenant_id", "property_state", "delinquency_bucket", F.col("events").alias("event_count"), F.col("loans").alias("loan_count"),
        "total_current_balance", F.col("n_serious").alias("serious_count"), (F.col("n_serious") / F.col("events")).alias("serious_share")))

EXECUTIVE_PORTFOLIO = Mart(
    "executive_portfolio", ("tenant_id", "event_month"), {
        "total_current_balance": (lambda: F.col("current_balance"), MONEY), "credit": (lambda: F.col("credit_score"), WHOLE),
        "cents": (lambda: F.round(F.col("_risk") * 100), WHOLE)},
    _complete, lambda g: g.select(
        "tenant_id", "event_month", F.col("loans").alias("active_loans"), F.col("events").alias("event_count"), "total_current_balance",
        (F.col("credit") / F.col("n_credit")).alias("avg_credit_score"), (F.col("cents") / F.col("n_cents") / 100).alias("avg_risk_score")))

MARTS = {m.name: m for m in (PAYMENT_AGG_MONTHLY, DELINQUENCY_DASHBOARD, EXECUTIVE_PORTFOLIO)}
