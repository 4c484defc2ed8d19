"""Bounded (state-based) refresh equals a full build, by brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanlake.functions.columns import ts_ntz_lit
from loanlake.operators import loan_state, marts, staging
from loanlake.sources import fixtures
from conftest import SF_SMALL


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("cut", [dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 1, 29)])
def test_state_refresh_equals_full_build(spark, cut):
    s = staging.stage_loans(fixtures.loan_events(spark, SF_SMALL))
    before = s.filter(F.col("loaded_at") < ts_ntz_lit(cut))
    target = marts.loan_portfolio(before).cache()
    state = loan_state.initial_state(before).cache()
    since = before.agg(F.max("loaded_at")).first()[0]
    out, dates, new_state = loan_state.refresh_with_state(s, target, state, since)
    full = marts.loan_portfolio(s)
    refreshed = target.filter(~F.col("event_date").isin(dates)).unionByName(out)
    assert rows(refreshed.drop("dbt_updated_at")) == rows(full.drop("dbt_updated_at"))
    assert rows(new_state) == rows(loan_state.initial_state(s))


def test_late_events_fall_back_exactly(spark):
    s = staging.stage_loans(fixtures.loan_events(spark, SF_SMALL))
    # deliver every third loan's events late: their old dates arrive after newer ones
    late = (F.abs(F.hash("loan_id")) % 3 == 0) & (F.col("event_date") < F.lit(dt.date(2024, 1, 20)))
    first = s.filter(~late)
    target = marts.loan_portfolio(first).cache()
    state = loan_state.initial_state(first).cache()
    since = first.agg(F.max("loaded_at")).first()[0]
    moved = s.withColumn("loaded_at", F.when(late, ts_ntz_lit(dt.datetime(2024, 3, 1))).otherwise(F.col("loaded_at")))
    out, dates, new_state = loan_state.refresh_with_state(moved, target, state, since)
    full = marts.loan_portfolio(moved)
    refreshed = target.filter(~F.col("event_date").isin(dates)).unionByName(out)
    assert rows(refreshed.drop("dbt_updated_at")) == rows(full.drop("dbt_updated_at"))
    assert rows(new_state) == rows(loan_state.initial_state(moved))


def test_state_refresh_with_hot_loans(spark):
    """Every loan routed as hot: known-hot in-order path and split fallback."""
    s = staging.stage_loans(fixtures.loan_events(spark, SF_SMALL))
    cut = dt.datetime(2024, 1, 15, 12)
    before = s.filter(F.col("loaded_at") < ts_ntz_lit(cut))
    target = marts.loan_portfolio(before).cache()
    state = loan_state.initial_state(before).cache()
    since = before.agg(F.max("loaded_at")).first()[0]
    out, dates, new_state = loan_state.refresh_with_state(s, target, state, since, max_rows_per_key=5)
    full = marts.loan_portfolio(s)
    refreshed = target.filter(~F.col("event_date").isin(dates)).unionByName(out)
    assert rows(refreshed.drop("dbt_updated_at")) == rows(full.drop("dbt_updated_at"))
    assert rows(new_state) == rows(loan_state.initial_state(s))


def test_initial_state_scans_its_source_once(spark):
    """Counts, both tails and the last events read the few input columns, written once."""
    s = staging.stage_loans(fixtures.loan_events(spark, SF_SMALL))
    plan = loan_state.initial_state(s)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [" not in plan and "parquet" not in plan
