"""Plan-shape checks that matter at scale: no Python in the hot path, one
exchange for the fact's windows, filters and column pruning at the scan, no
cartesian products anywhere."""

import os

import pytest

import __spark_entry__ as E
from loanlake.operators import marts, staging, stats
from loanlake.sources import fixtures
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_udf_and_no_cartesian(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_fact_windows_share_one_exchange(spark):
    p = plan(E.queries()["loan_portfolio"](spark, SF_SMALL))
    assert p.count("hashpartitioning(loan_id") == 1
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p     # no self-join


def test_staging_filter_and_pruning_reach_the_scan(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL)
    path = os.path.join(scratch, "raw")
    raw.write.parquet(path)
    t = spark.read.parquet(path)
    stg = staging.stage_loans(t).select("loan_id", "days_past_due")
    p = stg._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_valid), EqualTo(is_valid,true)]" in p
    assert "ReadSchema: struct<loan_id:string,days_past_due:int,is_valid:boolean>" in p


def test_load_report_partial_aggregation(spark):
    p = plan(stats.hourly_load_stats(fixtures.loan_events(spark, SF_SMALL)))
    assert "partial_count" in p and "partial_avg" in p


def test_dedup_is_a_combinable_aggregate(spark):
    p = plan(E.queries()["dedup_latest_event"](spark, SF_SMALL))
    assert "partial_max" in p and "Window" not in p


def test_fact_completeness_filter_after_windows(spark):
    df = marts.loan_portfolio(staging.stage_loans(fixtures.loan_events(spark, SF_SMALL)))
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("is_complete_record") < p.index("Window")   # printed top-down: filter above window


def test_small_batch_merge_streams_the_target(spark, scratch):
    from loanlake.operators import merge
    raw = fixtures.loan_events(spark, SF_SMALL)
    path = os.path.join(scratch, "target")
    raw.select("event_id").write.parquet(path)
    target = spark.read.parquet(path)
    batch = raw.limit(50)
    p = plan(merge.new_rows(batch, target, batch_key_bytes=2000))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    # the target scan feeds the semi-join directly: no shuffle of the target's keys
    scan_side = p[p.index("LeftSemi"):]
    first_scan = scan_side.index("FileScan parquet")
    assert "Exchange hashpartitioning(event_id" not in scan_side[:first_scan]
