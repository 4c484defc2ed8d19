"""Stream = batch: a file stream with duplicates, replays and late files
ends with the same raw table as a batch dedup (I1-I3, H4)."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from loanlake import schema as S
from loanlake.operators import stats
from loanlake.sources import fixtures, landing
from loanlake.streaming import ingest
from conftest import SF_SMALL


def shuffled_landing(spark, path, n_files=5):
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    dup = raw.orderBy("event_id").limit(200)             # 200 events delivered twice
    feed = raw.unionByName(dup).repartition(n_files, F.rand(seed=3))
    feed.select(landing.to_event_json(feed).alias("value")).write.text(path)
    return raw


def test_file_stream_with_duplicates_and_late_rows(spark, scratch):
    land, rawp, ck = (os.path.join(scratch, x) for x in ("landing", "raw", "ckpt"))
    raw = shuffled_landing(spark, land)
    q = ingest.start_ingest(spark, land, rawp, ck, rejects_path=os.path.join(scratch, "rej"),
                            audit_path=os.path.join(scratch, "audit"), max_files_per_trigger=1,
                            available_now=True, clock=lambda: dt.datetime(2024, 2, 1))
    q.awaitTermination(600)
    out = spark.read.parquet(rawp)
    assert out.count() == raw.count()                       # no late row dropped, no duplicate kept
    assert out.select("event_id").distinct().count() == raw.count()
    assert out.select(*S.EVENT_COLUMNS).exceptAll(raw.select(*S.EVENT_COLUMNS)).count() == 0
    audit = spark.read.json(os.path.join(scratch, "audit"))
    assert audit.agg(F.sum("rows_inserted")).first()[0] == raw.count()
    assert audit.count() == 5                               # one micro-batch per file

    # restart on the same checkpoint: nothing is re-read
    q2 = ingest.start_ingest(spark, land, rawp, ck, available_now=True)
    q2.awaitTermination(600)
    assert spark.read.parquet(rawp).count() == raw.count()

    # a fresh checkpoint replays every file: the merge makes it a no-op
    q3 = ingest.start_ingest(spark, land, rawp, os.path.join(scratch, "ckpt2"), available_now=True)
    q3.awaitTermination(600)
    assert spark.read.parquet(rawp).count() == raw.count()


def test_streaming_load_stats_equal_batch(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL)
    rawp = os.path.join(scratch, "raw")
    raw.withColumn("batch_id", F.lit("x")).write.parquet(rawp)
    s = ingest.streaming_load_stats(ingest.raw_stream(spark, rawp))
    q = (s.writeStream.format("memory").queryName("stream_stats").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.table("stream_stats")
    want = stats.hourly_load_stats(raw)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_dedup_within_watermark_drops_copies(spark, scratch):
    land = os.path.join(scratch, "landing")
    shuffled_landing(spark, land, n_files=1)
    docs = ingest.landing_stream(spark, land)
    parsed = docs.select(F.from_json("doc", "event_id string, event_timestamp string").alias("f")).select(
        "f.event_id", F.col("f.event_timestamp").try_cast("timestamp_ntz").alias("event_timestamp"))
    d = ingest.dedup_within_watermark(parsed, "30 days")
    q = d.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination(600)
    out = spark.table("dedup_out")
    assert out.count() == out.select("event_id").distinct().count()


@pytest.mark.parametrize("with_state", [False, True])
def test_stream_keeps_fact_current(spark, scratch, with_state):
    from loanlake.operators import marts, staging
    land, rawp, ck, fact = (os.path.join(scratch, x) for x in ("landing", "raw", "ckpt", "fact"))
    raw = shuffled_landing(spark, land, n_files=3)
    q = ingest.start_ingest(spark, land, rawp, ck, max_files_per_trigger=1, available_now=True,
                            clock=lambda: dt.datetime(2024, 2, 1), fact_path=fact,   # frozen clock
                            state_root=os.path.join(scratch, "state") if with_state else None)
    q.awaitTermination(900)
    loaded = spark.read.parquet(rawp)
    assert loaded.count() == raw.count()
    want = marts.loan_portfolio(staging.stage_loans(loaded, as_of=dt.datetime(2024, 2, 1, 0, 2)))
    got = spark.read.parquet(fact)
    cols = [c for c in want.columns if c not in ("dbt_updated_at", "loan_age_years")]
    assert sorted(repr(tuple(r)) for r in got.select(*cols).collect()) == \
        sorted(repr(tuple(r)) for r in want.select(*cols).collect())
