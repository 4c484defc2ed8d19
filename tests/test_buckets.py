"""Keyed tables in buckets, and what is kept in them: window state (H1) and history (Q9)."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loanlake.functions.columns import ts_ntz_lit
from loanlake.operators import history, loan_state, staging
from loanlake.plans import pipeline
from loanlake.plans.buckets import BucketedTable
from loanlake.plans.schema_record import read_table
from loanlake.plans.tables import read_raw
from loanlake.sources import fixtures, landing


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def files(root):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_a_write_touches_only_its_buckets(spark, scratch):
    root = os.path.join(scratch, "t")
    t = BucketedTable(spark, root, "k", bucket_rows=100)
    assert t.pointer() is None and t.read() is None and t.touched(spark.range(3).withColumnRenamed("id", "k")) == []
    t.write(spark.range(2000).select(F.col("id").alias("k"), F.lit("a").alias("v")), {"mark": 1})
    assert t.pointer()["buckets"] == 32 and t.pointer()["mark"] == 1 and t.read().count() == 2000
    before = files(root)
    keys = spark.createDataFrame([(5,), (7,), (1999,)], "k long")
    touched = t.touched(keys)
    assert 1 <= len(touched) <= 3
    old = t.read(touched)
    assert old.count() < 300
    t.replace(old.join(keys, "k", "left_anti").unionByName(keys.withColumn("v", F.lit("b"))), touched, {"mark": 2})
    written = {f: n for f, n in files(root).items() if f not in before}
    assert len(written) == len(touched) and sum(written.values()) < 0.25 * sum(before.values())
    assert t.read().where("v = 'b'").count() == 3 and t.read().count() == 2000 == t.pointer()["rows"]
    # the folders replaced are there for one more write
    assert set(before) <= set(files(root))
    t.replace(t.read([touched[0]]), [touched[0]])
    gone = set(before) - set(files(root))
    assert len(gone) == len(touched) and t.read().count() == 2000
    t.replace(t.read([]), [])
    assert t.read().count() == 2000


def test_buckets_double_and_empty_out(spark, scratch):
    t = BucketedTable(spark, os.path.join(scratch, "t"), "k", bucket_rows=50)
    t.write(spark.range(40).withColumnRenamed("id", "k"))
    assert t.pointer()["buckets"] == 1
    t.replace(spark.range(400).withColumnRenamed("id", "k"), [0])
    assert t.pointer()["buckets"] == 8 and t.pointer()["rows"] == 400 == t.read().count()
    everything = list(range(8))
    t.replace(t.read(everything).limit(0), everything)
    assert t.read().count() == 0 and t.pointer()["folders"] == {}
    t.replace(spark.createDataFrame([(None,), (3,)], "k long"), everything)
    assert t.read().count() == 2 and t.touched(spark.createDataFrame([(None,)], "k long"))


def test_a_write_that_dies_changes_nothing(spark, scratch, monkeypatch):
    t = BucketedTable(spark, os.path.join(scratch, "t"), "k", bucket_rows=50)
    t.write(spark.range(200).withColumnRenamed("id", "k"))
    monkeypatch.setattr(BucketedTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(RuntimeError):
        t.replace(t.read([0]).limit(1), [0])
    monkeypatch.undo()
    assert t.read().count() == 200
    t.replace(t.read([0]).limit(1), [0])
    assert t.read().count() < 200


def cfg(scratch, land, **kw):
    return pipeline.PipelineConfig(landing_dir=land, raw_path=os.path.join(scratch, "raw"), fact_path=os.path.join(scratch, "fact"),
                                   rejects_path=os.path.join(scratch, "rejects"), audit_path=os.path.join(scratch, "audit"),
                                   state_root=os.path.join(scratch, "state"), history_root=os.path.join(scratch, "history"), **kw)


def test_state_and_history_follow_the_runs(spark, scratch, monkeypatch):
    """Late days, a crash before the state is published, and state buckets that stay untouched."""
    import loanlake.plans.buckets as buckets
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 5)
    init = BucketedTable.__init__
    monkeypatch.setattr(BucketedTable, "__init__", lambda self, spark_, root, key: init(self, spark_, root, key, bucket_rows=5))
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    late = (F.abs(F.hash("loan_id")) % 4 == 0) & (F.col("event_date") < F.lit(dt.date(2024, 1, 12)))
    raw = raw.withColumn("event_date", F.col("event_timestamp").cast("date")).withColumn("_late", late)
    few = F.col("loan_id").isin([r["loan_id"] for r in raw.select("loan_id").distinct().orderBy("loan_id").limit(2).collect()])
    parts = [raw.filter("not _late and event_date < date'2024-01-16'"), raw.filter(few & (F.col("event_date") >= F.lit(dt.date(2024, 1, 16)))),
             raw.filter("_late"), raw.filter(~few & (F.col("event_date") >= F.lit(dt.date(2024, 1, 16))))]
    state = os.path.join(scratch, "state")
    for k, part in enumerate(parts):
        land = os.path.join(scratch, f"land{k}")
        landing.write_landing(part, land)
        before = files(state)
        if k == 2:                      # dies after the fact was swapped, before the state is published
            real = BucketedTable.replace
            monkeypatch.setattr(BucketedTable, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("lost the driver")))
            with pytest.raises(RuntimeError):
                pipeline.run_pipeline(spark, cfg(scratch, land, batch_id=f"x{k}", as_of=dt.datetime(2024, 2, k + 1)))
            monkeypatch.setattr(BucketedTable, "replace", real)
        audit = pipeline.run_pipeline(spark, cfg(scratch, land, batch_id=f"r{k}", as_of=dt.datetime(2024, 2, k + 1, 12)))
        if k == 1:
            fresh = {f: n for f, n in files(state).items() if f not in before}
            assert audit["history_loans"] == 2 and 1 <= len(fresh) <= 2 < len(before)
        stg = staging.stage_loans(read_raw(spark, os.path.join(scratch, "raw")))
        kept = BucketedTable(spark, state, "loan_id").read()
        assert rows(kept) == rows(loan_state.initial_state(stg).select(*kept.columns))
        runs = BucketedTable(spark, os.path.join(scratch, "history"), "loan_id").read()
        assert rows(history.versions(runs)) == rows(history.scd2(stg))
    from loanlake.operators import marts
    fact, want = read_table(spark, os.path.join(scratch, "fact")), marts.loan_portfolio(stg)
    cols = [c for c in want.columns if c not in ("dbt_updated_at", "loan_age_years")]
    assert rows(fact.select(*cols)) == rows(want.select(*cols))


def test_state_asked_for_later_is_built(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    l1, l2 = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    cut = ts_ntz_lit(dt.datetime(2024, 1, 20))
    landing.write_landing(raw.filter(F.col("loaded_at") < cut), l1)
    landing.write_landing(raw.filter(F.col("loaded_at") >= cut), l2)
    one = cfg(scratch, l1, batch_id="a", as_of=dt.datetime(2024, 2, 1))
    one.state_root = one.history_root = None
    pipeline.run_pipeline(spark, one)
    pipeline.run_pipeline(spark, cfg(scratch, l2, batch_id="b", as_of=dt.datetime(2024, 2, 2)))
    stg = staging.stage_loans(read_raw(spark, os.path.join(scratch, "raw")))
    kept = BucketedTable(spark, os.path.join(scratch, "state"), "loan_id").read()
    assert rows(kept) == rows(loan_state.initial_state(stg).select(*kept.columns))


@pytest.mark.parametrize("seed,hot", [(1, 100_000), (2, 100_000), (3, 8)])
def test_history_batches_in_any_order(spark, scratch, seed, hot):
    r = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    events = [(f"L{r.randrange(12)}", f"e{i}", r.choice("ab") if r.random() < .9 else None, r.choice([None, "x", "y"]),
               t0 + dt.timedelta(hours=r.randrange(200)) if r.random() < .97 else None) for i in range(400)]
    events += [(None, f"n{i}", r.choice("ab"), "x", t0 + dt.timedelta(hours=i)) for i in range(10)]
    schema = "loan_id string, event_id string, delinquency_bucket string, credit_tier string, event_timestamp timestamp_ntz"
    if seed != 2:
        r.shuffle(events)
    else:
        events.sort(key=lambda e: (e[4] is not None, e[4] or t0))
    runs, done = None, []
    for lo in range(0, len(events), 140):
        batch = events[lo:lo + 140]
        done += batch
        every = spark.createDataFrame(done, schema)
        runs = history.build_runs(every, max_rows_per_key=hot) if runs is None else history.merge_runs(
            runs, spark.createDataFrame(batch, schema), every, max_rows_per_key=hot)
        runs = runs.checkpoint()
        assert rows(history.versions(runs, max_rows_per_key=hot)) == rows(history.scd2(every))
