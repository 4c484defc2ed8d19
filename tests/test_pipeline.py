"""End-to-end scheduled runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loanlake.functions.columns import ts_ntz_lit

from loanlake.operators import marts, staging
from loanlake.plans import pipeline
from loanlake.plans.tables import VersionedTable, read_raw
from loanlake.sources import fixtures, landing
from conftest import SF_SMALL


def cfg(scratch, land, **kw):
    kw.setdefault("dim_root", os.path.join(scratch, "dim"))
    return pipeline.PipelineConfig(landing_dir=land, raw_path=os.path.join(scratch, "raw"),
                                   fact_path=os.path.join(scratch, "fact"),
                                   rejects_path=os.path.join(scratch, "rejects"),
                                   audit_path=os.path.join(scratch, "audit"), **kw)


@pytest.mark.parametrize("by_date,with_state", [(False, False), (True, False), (False, True)])
def test_two_runs_then_replay(spark, scratch, by_date, with_state):
    state_root = os.path.join(scratch, "state") if with_state else None
    raw = fixtures.loan_events(spark, SF_SMALL)
    cut = ts_ntz_lit(dt.datetime(2024, 1, 15, 12))
    l1, l2 = os.path.join(scratch, "land1"), os.path.join(scratch, "land2")
    landing.write_landing(raw.filter(F.col("loaded_at") < cut), l1)
    landing.write_landing(raw.filter(F.col("loaded_at") >= cut), l2)
    a = pipeline.run_pipeline(spark, cfg(scratch, l1, batch_id="r1", as_of=dt.datetime(2024, 1, 15, 12),
                                         raw_by_event_date=by_date, state_root=state_root))
    old_part = os.path.join(scratch, "fact", "event_date=2024-01-05")
    before = sorted((f, os.path.getmtime(os.path.join(old_part, f))) for f in os.listdir(old_part))
    b = pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r2", as_of=dt.datetime(2024, 1, 31),
                                         raw_by_event_date=by_date, state_root=state_root))
    after = sorted((f, os.path.getmtime(os.path.join(old_part, f))) for f in os.listdir(old_part))
    assert before == after                                   # partitions before the new data untouched
    c = pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r3", as_of=dt.datetime(2024, 1, 31),
                                         raw_by_event_date=by_date, state_root=state_root))
    assert c["status"] == "skipped" and c["rows_inserted"] == 0                      # each file is loaded once
    loaded = read_raw(spark, os.path.join(scratch, "raw"))
    good = raw.filter("borrower_id is not null")
    assert loaded.count() == good.count() == a["rows_inserted"] + b["rows_inserted"]
    fact = spark.read.parquet(os.path.join(scratch, "fact"))
    assert b["fact_dates_rewritten"] > 0
    want = marts.loan_portfolio(staging.stage_loans(loaded))
    cols = [c for c in want.columns if c not in ("dbt_updated_at", "loan_age_years")]
    assert sorted(repr(tuple(r)) for r in fact.select(*cols).collect()) == \
        sorted(repr(tuple(r)) for r in want.select(*cols).collect())
    assert spark.read.json(os.path.join(scratch, "audit")).count() == 2
    dim = VersionedTable(spark, os.path.join(scratch, "dim")).read()
    want_dim = marts.dim_loan_attributes(staging.stage_loans(loaded))
    assert sorted(repr(tuple(r)) for r in dim.select(*want_dim.columns).collect()) == \
        sorted(repr(tuple(r)) for r in want_dim.collect())
    assert spark.read.json(os.path.join(scratch, "rejects")).count() > 0             # NULL borrowers quarantined


def test_empty_landing_is_skipped(spark, scratch):
    land = os.path.join(scratch, "empty")
    os.makedirs(land)
    with open(os.path.join(land, "part-0.txt"), "w") as f:
        f.write("\n")
    out = pipeline.run_pipeline(spark, cfg(scratch, land, batch_id="e"))
    assert out["status"] == "skipped"


def test_gate_stops_on_reject_share(spark, scratch):
    land = os.path.join(scratch, "bad")
    os.makedirs(land)
    with open(os.path.join(land, "part-0.txt"), "w") as f:
        f.write("{not json\n" * 10)
    with pytest.raises(pipeline.QualityGateError):
        pipeline.run_pipeline(spark, cfg(scratch, land, batch_id="b"))
    assert not os.path.exists(os.path.join(scratch, "raw"))                         # nothing loaded


def test_critical_range_rule_stops_run(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL)
    land = os.path.join(scratch, "land")
    landing.write_landing(raw, land)
    with pytest.raises(pipeline.QualityGateError):
        pipeline.run_pipeline(spark, cfg(scratch, land, batch_id="x",
                                         critical_rules=("original_balance_positive",)))


def test_failed_refresh_is_redone_by_next_run(spark, scratch, monkeypatch):
    raw = fixtures.loan_events(spark, SF_SMALL)
    cut = ts_ntz_lit(dt.datetime(2024, 1, 15, 12))
    l1, l2 = (os.path.join(scratch, x) for x in ("land1", "land2"))
    landing.write_landing(raw.filter(F.col("loaded_at") < cut), l1)
    landing.write_landing(raw.filter(F.col("loaded_at") >= cut), l2)
    pipeline.run_pipeline(spark, cfg(scratch, l1, batch_id="r1", as_of=dt.datetime(2024, 1, 15, 12)))
    real = pipeline.fact_tests
    monkeypatch.setattr(pipeline, "fact_tests", lambda fact: (_ for _ in ()).throw(RuntimeError("boom")))
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r2", as_of=dt.datetime(2024, 1, 31)))
    monkeypatch.setattr(pipeline, "fact_tests", real)
    # rows of r2 are in raw, the watermark still points at r1: replaying r2 loads nothing new
    # but the refresh picks up every loan touched since r1
    out = pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r3", as_of=dt.datetime(2024, 2, 1)))
    assert out["rows_inserted"] == 0 and out["fact_dates_rewritten"] > 0
    loaded = spark.read.parquet(os.path.join(scratch, "raw"))
    fact = spark.read.parquet(os.path.join(scratch, "fact"))
    want = marts.loan_portfolio(staging.stage_loans(loaded))
    cols = [c for c in want.columns if c not in ("dbt_updated_at", "loan_age_years")]
    assert sorted(repr(tuple(r)) for r in fact.select(*cols).collect()) == \
        sorted(repr(tuple(r)) for r in want.select(*cols).collect())


def _two_landings(spark, scratch, undated=False):
    raw = fixtures.undated_events(spark, SF_SMALL) if undated else fixtures.loan_events(spark, SF_SMALL)
    cut = ts_ntz_lit(dt.datetime(2024, 1, 15, 12))
    l1, l2 = (os.path.join(scratch, x) for x in ("land1", "land2"))
    landing.write_landing(raw.filter(F.col("loaded_at") < cut), l1)
    landing.write_landing(raw.filter(F.col("loaded_at") >= cut), l2)
    return l1, l2


def _fact_equals_full_build(spark, scratch):
    want = marts.loan_portfolio(staging.stage_loans(read_raw(spark, os.path.join(scratch, "raw"))))
    cols = [c for c in want.columns if c not in ("dbt_updated_at", "loan_age_years")]
    fact = spark.read.parquet(os.path.join(scratch, "fact"))
    assert sorted(repr(tuple(r)) for r in fact.select(*cols).collect()) == \
        sorted(repr(tuple(r)) for r in want.select(*cols).collect())


@pytest.mark.parametrize("with_state", [False, True])
def test_undated_events_survive_incremental_runs(spark, scratch, with_state):
    l1, l2 = _two_landings(spark, scratch, undated=True)
    state = os.path.join(scratch, "state") if with_state else None
    pipeline.run_pipeline(spark, cfg(scratch, l1, batch_id="r1", as_of=dt.datetime(2024, 1, 15, 12), state_root=state))
    pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r2", as_of=dt.datetime(2024, 1, 31), state_root=state))
    _fact_equals_full_build(spark, scratch)


def test_crash_inside_the_swap_loses_nothing(spark, scratch, monkeypatch):
    import shutil
    from loanlake.plans import tables
    l1, l2 = _two_landings(spark, scratch)
    pipeline.run_pipeline(spark, cfg(scratch, l1, batch_id="r1", as_of=dt.datetime(2024, 1, 15, 12)))
    real = tables.finish_swap

    def die(spark_, path):
        mark = tables.read_marker(spark_, tables.swap_marker(path))
        if mark is None:
            return False
        # between delete and rename: the replaced partitions are gone, the new ones not there yet
        for part in os.listdir(mark["staging"].removeprefix("file:")):
            if part.startswith("event_date=") and os.path.isdir(os.path.join(path, part)):
                shutil.move(os.path.join(path, part), os.path.join(scratch, "lost-" + part))
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(tables, "finish_swap", die)
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r2", as_of=dt.datetime(2024, 1, 31)))
    monkeypatch.setattr(tables, "finish_swap", real)
    pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="r3", as_of=dt.datetime(2024, 2, 1)))
    _fact_equals_full_build(spark, scratch)
    assert not os.path.exists(tables.swap_marker(os.path.join(scratch, "fact")))


def test_first_build_that_died_is_replaced(spark, scratch):
    l1, _ = _two_landings(spark, scratch)
    os.makedirs(os.path.join(scratch, "fact", "_temporary", "0"))
    pipeline.run_pipeline(spark, cfg(scratch, l1, batch_id="r1", as_of=dt.datetime(2024, 1, 15, 12)))
    _fact_equals_full_build(spark, scratch)


def test_second_run_loads_only_new_files(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null").orderBy("event_id")
    land = os.path.join(scratch, "land")
    first = raw.limit(400)
    landing.write_landing(first, land)
    pipeline.run_pipeline(spark, cfg(scratch, land, batch_id="r1", as_of=dt.datetime(2024, 2, 1)))
    landing.write_landing(raw.join(first, "event_id", "left_anti").orderBy("event_id").limit(50), land)
    out = pipeline.run_pipeline(spark, cfg(scratch, land, batch_id="r2", as_of=dt.datetime(2024, 2, 2)))
    assert (out["batch_rows"], out["rows_inserted"], out["rows_skipped"]) == (50, 50, 0)


def test_rejects_are_written_before_the_gate(spark, scratch):
    land = os.path.join(scratch, "bad2")
    os.makedirs(land)
    with open(os.path.join(land, "part-0.txt"), "w") as f:
        f.write("{not json\n" * 10)
    with pytest.raises(pipeline.QualityGateError):
        pipeline.run_pipeline(spark, cfg(scratch, land, batch_id="b"))
    assert spark.read.json(os.path.join(scratch, "rejects", "batch=b")).count() == 10


def test_versioned_table_keeps_two_versions(spark, scratch):
    t = VersionedTable(spark, os.path.join(scratch, "vt"))
    for n in range(4):
        t.write(spark.range(n))
    assert t.read().count() == 3
    assert sorted(x for x in os.listdir(os.path.join(scratch, "vt")) if x.startswith("v=")) == ["v=2", "v=3"]
