"""Incremental refresh of the portfolio fact and keyed upserts.

``new_since_max_date`` is the written incremental filter: staging rows with
``event_date`` strictly after the target's latest date. It restarts rolling
windows at every run (K1), skips later events of an already loaded day (K2)
and selects nothing on an empty target (K3).

``refresh_fact`` is the default: new events are found by ``event_id``
(anti-join against the target, so late and same-day events are kept), every
loan touched by a new event is recomputed over its *full* history, and the
untouched loans' rows are carried over. The result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions.columns import ts_ntz_lit
from loanlake.operators import marts
from loanlake.plans.schema_record import synced
from loanlake.session import ensure_checkpoint_dir


def max_event_date(target: DataFrame):
    """Scalar MAX(event_date) of the target (G5); one value to the driver."""
    return target.agg(F.max("event_date").alias("m")).first()["m"]


def new_since_max_date(stg: DataFrame, target: DataFrame, full_build_when_empty: bool = False) -> DataFrame:
    """Rows with event_date > MAX(target.event_date) (C5). The bound is a
    literal once computed, so a date-partitioned source prunes partitions."""
    m = max_event_date(target)
    if m is None:
        return stg if full_build_when_empty else stg.limit(0)
    return stg.filter(F.col("event_date") > F.lit(m))


def first_changes(fresh: DataFrame) -> DataFrame:
    """(loan_id, _d0, _all): the earliest date of each loan's new events, and
    whether one of them has none. A NULL date sorts first, so such an event
    moves every window of its loan."""
    return fresh.groupBy("loan_id").agg(F.min("event_date").alias("_d0"),
                                        F.max(F.col("event_date").isNull()).alias("_all"))


def is_rebuilt():
    """Whether a row joined with ``first_changes`` (left) can have changed."""
    return F.coalesce(F.col("_all") | (F.col("event_date") >= F.col("_d0")), F.lit(False))


def in_dates(dates: list):
    """Rows of these event dates; None stands for rows without a date."""
    known = [d for d in dates if d is not None]
    cond = F.col("event_date").isin(known) if known else F.lit(False)
    return cond | F.col("event_date").isNull() if None in dates else cond


def event_dates(df: DataFrame) -> list:
    """The event dates of ``df``, None last: one value per calendar day, so
    bounded by the calendar and safe to collect."""
    return sorted((r[0] for r in df.select("event_date").distinct().collect()), key=lambda d: (d is None, d))


def refresh_fact(stg: DataFrame, target: DataFrame | None, since=None, **fact_kwargs) -> DataFrame:
    """Fact after adding every staging event not yet in ``target`` (H1, K1-K3).

    First run (no target): full build. Later runs: recompute affected loans
    over their whole history; union with the untouched loans' target rows.
    New events are those loaded after ``since`` (the previous run's
    ``loaded_at`` high-water mark) - late and same-day events included.
    Without ``since`` they are found by anti-join on event_id; incomplete
    events never reach the fact, so their loans are then always recomputed
    (still exact, only more work).
    """
    if target is None:
        return marts.loan_portfolio(stg, **fact_kwargs)
    if since is not None:
        fresh = stg.filter(F.col("loaded_at") > ts_ntz_lit(since))
    else:
        fresh = stg.join(target.select("event_id"), "event_id", "left_anti")
    affected = fresh.select("loan_id").distinct()
    rebuilt = marts.loan_portfolio(stg.join(affected, "loan_id", "left_semi"), **fact_kwargs)
    kept, rebuilt = synced(target.join(affected, "loan_id", "left_anti"), rebuilt)
    return kept.unionByName(rebuilt)


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, greatest ``order`` wins (deterministic: the remaining
    columns break ties). A combinable max(struct) aggregate."""
    rest = [c for c in df.columns if c != key and c not in order]
    return (df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_b"))
            .select(key, *[F.col(f"_b.{c}").alias(c) for c in (*order, *rest)]).select(*df.columns))


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Schema sync (H3): target reshaped to the source's columns - new
    columns arrive as NULL, columns the source dropped are removed, types stay
    the source's."""
    return target.unionByName(source.limit(0), allowMissingColumns=True).select(*source.columns)


def upsert(target: DataFrame, source: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Merge on ``key`` (H2): source rows replace target rows with the same
    key; several source rows per key collapse to the latest first (K4)."""
    src = latest_per_key(source, key, order)
    tgt = sync_columns(target, src)
    return tgt.join(src.select(key), key, "left_anti").unionByName(src)


def changed_partitions(stg: DataFrame, target: DataFrame, since, **fact_kwargs):
    """Rows of the fact's ``event_date`` partitions that a refresh changes.

    Every fact window looks backwards (ROWS frames, LAG, running totals whose
    RANGE peers share a date), so a loan's rows dated before its earliest new
    event cannot change. Per affected loan L with earliest new date d0(L):
    rows on/after d0(L) are rebuilt from L's history - all of them if a new
    event has no date, which sorts first; every other row of the touched
    dates is carried over from the target (partition-pruned read). Returns
    (rows for the touched dates, list of touched dates); the caller
    overwrites exactly those partitions (None: the rows without a date). The
    rows have the table's schema after a sync with the rebuilt ones (H3).
    With in-order feeds that is the current day, not the table.
    """
    fresh = stg.filter(F.col("loaded_at") > ts_ntz_lit(since)) if since is not None else \
        stg.join(target.select("event_id"), "event_id", "left_anti")
    ensure_checkpoint_dir(stg.sparkSession)
    affected = first_changes(fresh).checkpoint()
    history = stg.join(affected.select("loan_id"), "loan_id", "left_semi")
    fact = marts.loan_portfolio(history, **fact_kwargs)
    rebuilt = fact.join(affected, "loan_id").filter(is_rebuilt()).select(*fact.columns).checkpoint()
    dates = event_dates(rebuilt)
    if not dates:
        return None, []
    kept = target.filter(in_dates(dates)).join(affected, "loan_id", "left").filter(~is_rebuilt()).drop("_d0", "_all")
    kept, rebuilt = synced(kept, rebuilt)
    return kept.unionByName(rebuilt), dates
