"""The bucketed key check of the raw table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loanlake import schema as S
from loanlake.operators import merge
from loanlake.plans import key_index, pipeline
from loanlake.plans.key_index import KeyIndex
from loanlake.plans.tables import read_raw
from loanlake.sources import fixtures, landing


def keys(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("EV-"), F.sha2(F.col("id").cast("string"), 256).substr(1, 20)).alias("event_id"))


def read_bytes(paths):
    return sum(os.path.getsize(os.path.join(p, f)) for p in paths for f in os.listdir(p) if f.endswith(".parquet"))


def test_bytes_read_stay_level_while_the_table_grows(spark, scratch):
    batch = keys(spark, 100, 104).unionByName(keys(spark, 10 ** 9, 10 ** 9 + 4))
    read, folders = [], []
    for n in (5_000, 50_000):
        index = KeyIndex(spark, os.path.join(scratch, f"i{n}"), bucket_keys=500)
        index.build(keys(spark, 0, n))
        paths = index.touched(batch)
        assert 1 <= len(paths) <= 8
        read.append(read_bytes(paths) / len(paths))
        folders.append(index.pointer()["buckets"])
        found = sorted(r["event_id"] for r in index.known(batch).collect())
        assert found == sorted(r["event_id"] for r in keys(spark, 100, 104).collect())
    assert folders == [16, 128] and read[1] < 1.5 * read[0]


def test_appends_growth_and_compaction(spark, scratch):
    index = KeyIndex(spark, os.path.join(scratch, "i"), bucket_keys=300, max_appends=3)
    index.recover(None)
    assert index.known(keys(spark, 0, 5)).count() == 0 and index.all_keys() is None
    for k in range(8):
        index.add(keys(spark, 100 * k, 100 * (k + 1)), 100)
        assert index.all_keys().count() == 100 * (k + 1) == index.pointer()["keys"]
    p = index.pointer()
    assert p["buckets"] == 4 and p["appends"] <= 3 and p["gen"] >= 2
    assert index.known(keys(spark, 750, 900)).count() == 50
    kept = [x for x in os.listdir(os.path.join(scratch, "i")) if x.startswith("gen=")]
    assert len(kept) <= 2
    index.add(keys(spark, 0, 1), 0)
    assert index.pointer()["keys"] == 800
    odd = spark.createDataFrame([(None,), ("",), ("EV-é",)], "event_id string")
    index.add(odd, 3)
    assert sorted(r["event_id"] for r in index.known(odd.union(odd)).collect()) == ["", "EV-é"]


def load(spark, scratch, events, batch_id, by_date, at):
    index = KeyIndex(spark, os.path.join(scratch, "keys"), bucket_keys=200)
    batch = landing.apply_defaults(events.select(*S.EVENT_COLUMNS), at, batch_id)
    return merge.load_batch(spark, batch, os.path.join(scratch, "raw"), batch_id, by_event_date=by_date, index=index)


@pytest.mark.parametrize("by_date", [False, True])
def test_a_key_is_known_whatever_its_timestamp(spark, scratch, by_date):
    events = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    first, n = events.filter("event_timestamp < timestamp'2024-01-10'"), events.count()
    a = load(spark, scratch, first, "a", by_date, dt.datetime(2024, 2, 1))
    assert a["rows_inserted"] == first.count() == a["batch_rows"]
    moved = first.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("interval 9 days"))
    b = load(spark, scratch, moved.unionByName(events), "b", by_date, dt.datetime(2024, 2, 2))
    assert b["rows_inserted"] == n - a["rows_inserted"]
    c = load(spark, scratch, events, "c", by_date, dt.datetime(2024, 2, 3))
    assert c["rows_inserted"] == 0 and c["rows_skipped"] == n
    raw = read_raw(spark, os.path.join(scratch, "raw"))
    assert raw.count() == n == raw.select("event_id").distinct().count()


@pytest.mark.parametrize("where", ["before the keys", "inside the keys"])
def test_a_crash_between_rows_and_keys_inserts_nothing_twice(spark, scratch, monkeypatch, where):
    events = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    part = events.filter("event_timestamp < timestamp'2024-01-10'")
    load(spark, scratch, part, "a", False, dt.datetime(2024, 2, 1))
    real = KeyIndex.add

    def die(self, new, n):
        if where == "inside the keys":
            self._write(new, self.pointer()["gen"], self.pointer()["buckets"], "append")
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(KeyIndex, "add", die)
    with pytest.raises(RuntimeError):
        load(spark, scratch, events, "b", False, dt.datetime(2024, 2, 2))
    monkeypatch.setattr(KeyIndex, "add", real)
    again = load(spark, scratch, events, "b2", False, dt.datetime(2024, 2, 3))
    raw = read_raw(spark, os.path.join(scratch, "raw"))
    assert again["rows_inserted"] == 0 and raw.count() == events.count()
    index = KeyIndex(spark, os.path.join(scratch, "keys"), bucket_keys=200)
    assert index.all_keys().distinct().count() == events.count()
    assert not os.path.exists(os.path.join(scratch, "keys", "_pending.json"))


def test_an_index_of_an_older_table_is_built_from_it(spark, scratch):
    events = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    batch = landing.apply_defaults(events.select(*S.EVENT_COLUMNS), dt.datetime(2024, 2, 1), "a")
    merge.load_batch(spark, batch, os.path.join(scratch, "raw"), "a")
    assert load(spark, scratch, events, "b", False, dt.datetime(2024, 2, 2))["rows_inserted"] == 0


def test_pipeline_with_an_index(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    land = os.path.join(scratch, "land")
    landing.write_landing(raw.limit(500), land)
    cfg = dict(landing_dir=land, raw_path=os.path.join(scratch, "raw"), fact_path=os.path.join(scratch, "fact"),
               rejects_path=os.path.join(scratch, "rej"), audit_path=os.path.join(scratch, "audit"),
               key_index_root=os.path.join(scratch, "keys"))
    a = pipeline.run_pipeline(spark, pipeline.PipelineConfig(batch_id="a", as_of=dt.datetime(2024, 2, 1), **cfg))
    landing.write_landing(raw, land)
    b = pipeline.run_pipeline(spark, pipeline.PipelineConfig(batch_id="b", as_of=dt.datetime(2024, 2, 2), **cfg))
    assert a["rows_inserted"] == 500 and b["rows_inserted"] == raw.count() - 500
    assert KeyIndex(spark, cfg["key_index_root"]).pointer()["keys"] == raw.count()
    assert key_index.BUCKET_KEYS >= raw.count()
