"""Landing files, quarantine and exactly-once loading."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from loanlake import schema as S
from loanlake.operators import merge
from loanlake.sources import fixtures, landing
from conftest import SF_SMALL


def event(i, **kw):
    e = {
        "event_id": f"e-{i}", "loan_id": "LN-000001-A", "borrower_id": "BRW-0000000A", "tenant_id": "mortgage_servicer_a",
        "event_type": "PAYMENT", "loan_type": "FHA", "loan_purpose": "PURCHASE", "origination_date": "2020-01-15",
        "maturity_date": "2050-01-15", "original_balance": 250000.0, "current_balance": 200000.0,
        "interest_rate": 0.05, "monthly_payment": 1342.05, "payment_amount": 1342.05, "days_past_due": 0,
        "property_state": "CA", "credit_score": 710, "ltv_ratio": 0.8, "dti_ratio": 0.3,
        "event_timestamp": f"2024-01-02T03:04:{i:02d}.123456", "is_valid": True}
    e.update(kw)
    return e


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_array_files_good_bad_field_not_json_extra_and_duplicate_key(spark, scratch):
    d = os.path.join(scratch, "landing")
    write(d, "good.json", json.dumps([event(1), event(2, payment_amount=None), event(3)]))
    write(d, "badfield.json", json.dumps([event(4), event(5, days_past_due="x"), event(6)]))
    write(d, "notjson.json", "{not json")
    write(d, "extra.json", json.dumps([event(7, unknown_field=42)]))
    write(d, "dupkey.json", '[{"event_id": "e-8", "event_id": "e-9"}]')
    events, rejects = landing.read_landing(spark, d, layout="array")
    got = {r["event_id"]: r for r in events.collect()}
    assert sorted(got) == ["e-1", "e-2", "e-3", "e-4", "e-6", "e-7"]      # siblings of the bad row kept
    assert got["e-2"]["payment_amount"] is None                            # explicit null kept
    assert got["e-1"]["event_timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 1, 123456)
    assert got["e-1"]["origination_date"] == dt.date(2020, 1, 15)
    rj = rejects.collect()
    reasons = sorted(r["reason"] for r in rj)
    assert reasons == ["bad_field:days_past_due", "malformed_json", "malformed_json"]
    assert sorted(os.path.basename(r["source"]) for r in rj if r["reason"] == "malformed_json") == \
        ["dupkey.json", "notjson.json"]


def test_json_lines_landing_roundtrip_and_not_null_quarantine(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL)
    d = os.path.join(scratch, "landing")
    landing.write_landing(raw, d)
    assert any(p.startswith("ds=") for p in os.listdir(d))
    events, rejects = landing.read_landing(spark, d)
    assert events.count() + rejects.count() == raw.count()
    assert rejects.filter(F.col("reason") == "not_null:borrower_id").count() == raw.filter("borrower_id is null").count()
    a = events.exceptAll(raw.filter("borrower_id is not null").select(*S.EVENT_COLUMNS))
    assert a.count() == 0
    landing.write_rejects(rejects, os.path.join(scratch, "dlq"))
    assert spark.read.json(os.path.join(scratch, "dlq")).count() == rejects.count()


def test_publish_records_key_and_nulls(spark):
    raw = fixtures.loan_events(spark, SF_SMALL).limit(5)
    msgs = landing.publish_records(raw).collect()
    for m in msgs:
        obj = json.loads(m["value"])
        assert m["key"] == obj["tenant_id"] and set(obj) == set(S.EVENT_COLUMNS)   # nulls written, not dropped


def test_load_batch_replay_inserts_nothing_and_in_batch_duplicates(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    batch = landing.apply_defaults(raw.select(*S.EVENT_COLUMNS), dt.datetime(2024, 2, 1), "b1")
    dup = batch.limit(10).withColumn("current_balance", F.col("current_balance") + 1)
    target = os.path.join(scratch, "raw")
    first = merge.load_batch(spark, batch.unionByName(dup), target, "b1")
    n = raw.count()
    assert first == {"batch_id": "b1", "batch_rows": n + 10, "rows_inserted": n, "rows_skipped": 10}
    again = merge.load_batch(spark, batch, target, "b2")
    assert again["rows_inserted"] == 0 and again["rows_skipped"] == n
    assert spark.read.parquet(target).count() == n
    empty = merge.load_batch(spark, batch.limit(0), target, "b3")
    assert empty["rows_inserted"] == 0 and empty["batch_rows"] == 0


def test_defaults_fill_only_absent_columns(spark):
    df = spark.createDataFrame([("e", None)], "event_id string, days_past_due int")
    full = df
    for c in S.EVENT_COLUMNS:
        if c not in full.columns:
            full = full.withColumn(c, F.lit(None).cast(dict(S.EVENT_FIELDS)[c]))
    out = landing.apply_defaults(full.drop("is_valid"), dt.datetime(2024, 1, 1), "b").first()
    assert out["days_past_due"] is None and out["is_valid"] is True and out["batch_id"] == "b"


def test_bus_without_connector_is_reported(spark):
    from loanlake.sources import bus
    raw = fixtures.loan_events(spark, SF_SMALL).limit(3)
    try:
        bus.publish(raw, "localhost:1", "loan_events_raw")
    except bus.BusUnavailable:
        pass                      # expected here: no connector jar in this environment
    except Exception as e:        # connector present but no broker: also acceptable
        assert "kafka" in str(e).lower()


def test_dedup_hot_key_combines_map_side(spark):
    base = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string"))).alias("event_id"),
        F.col("id").cast("timestamp").alias("event_timestamp"), F.col("id").cast("timestamp").alias("loaded_at"),
        F.col("id").alias("v"))
    out = merge.dedup_latest(base)
    assert out.count() == 20001
    hot = out.filter("event_id = 'HOT'").first()
    assert hot["v"] == 29997          # the latest copy wins
    assert "partial_max" in out._jdf.queryExecution().executedPlan().toString()


def test_gzip_array_file_and_invalid_utf8(spark, scratch):
    import gzip
    d = os.path.join(scratch, "landing")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "batch.json.gz"), "wt") as f:
        f.write(json.dumps([event(1), event(2)]))
    with open(os.path.join(d, "latin1.json"), "wb") as f:
        f.write(json.dumps([event(3, property_state="CA")]).encode("utf-8").replace(b'"CA"', b'"C\xe9"'))
    events, rejects = landing.read_landing(spark, d, layout="array")
    assert sorted(r["event_id"] for r in events.collect()) == ["e-1", "e-2"]
    assert [r["reason"] for r in rejects.collect()] == ["invalid_utf8"]


def test_load_batch_by_event_date_prunes_and_stays_exact(spark, scratch):
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    batch = landing.apply_defaults(raw.select(*S.EVENT_COLUMNS), dt.datetime(2024, 2, 1), "b1")
    target = os.path.join(scratch, "raw_by_date")
    first = merge.load_batch(spark, batch.filter("event_timestamp < '2024-01-10'"), target, "b1", by_event_date=True)
    second = merge.load_batch(spark, batch, target, "b2", by_event_date=True)
    n = raw.count()
    assert first["rows_inserted"] + second["rows_inserted"] == n
    assert second["rows_skipped"] == first["rows_inserted"]
    t = spark.read.parquet(target)
    assert t.count() == n and t.select("event_id").distinct().count() == n
    assert any(p.startswith("event_date=") for p in os.listdir(target))
    # a replay of one day's events reads only that day's partition
    day = batch.filter("cast(event_timestamp as date) = date'2024-01-05'")
    again = merge.load_batch(spark, day, target, "b3", by_event_date=True)
    assert again["rows_inserted"] == 0 and again["rows_skipped"] == day.count()


def test_large_array_file_loads_in_full(spark, scratch):
    """One array file of about 200 MiB: no limit of a single VARIANT applies."""
    import os
    n, path = 480_000, os.path.join(scratch, "big.json")
    with open(path, "w") as f:
        f.write("[")
        for i in range(n):
            f.write((",\n" if i else "") + '{"event_id": "E%d", "loan_id": "L%d", "borrower_id": "B", "tenant_id": "t", '
                    '"event_type": "PAYMENT", "payment_amount": %d.25, "loan_purpose": "%s"}' % (i, i % 97, i % 1000, "x" * 300))
        f.write(', {"event_id": "dup", "event_id": "dup"}, 7]')
    assert os.path.getsize(path) > 200 << 20
    events, rejects = landing.read_landing(spark, path, layout="array")
    assert events.count() == n
    assert sorted(r["reason"] for r in rejects.select("reason").collect()) == [
        "malformed_json", "not_null:event_id,loan_id,borrower_id,tenant_id,event_type"]


def test_text_of_fields_and_documents_that_are_no_objects(spark):
    """Other JSON than objects, nested values, numbers in text fields, keys that repeat or differ in case."""
    lines = ['[1, 2]', '"text"', "12", "null", "", "  ", '{"a": 1} trailing', json.dumps(event(1)) + " ", "\t" + json.dumps(event(2, event_id=7)),
             json.dumps(event(3, loan_type={"x": [1, "é"]}, credit_score="700", interest_rate=1e-3)), json.dumps(event(4, days_past_due=2 ** 40)),
             json.dumps(event(5))[:-1] + ', "loan_id": "again"}', json.dumps(event(6)).replace("loan_id", "Loan_Id"),
             json.dumps(event(8, is_valid="yes", event_timestamp=None)), json.dumps(event(9, original_balance=None, ltv_ratio="0.5"))]
    docs = spark.createDataFrame([(x, f"f{i}") for i, x in enumerate(lines)], "doc string, source string")
    got = {r["source"]: r for r in landing.parse_tagged(docs).collect()}
    reason = {k: r["reason"] for k, r in got.items()}
    assert len(got) == len(lines)
    none = "not_null:" + ",".join(S.NOT_NULL_COLUMNS)
    assert [reason[f"f{i}"] for i in range(4)] == [none] * 4
    assert {i: reason[f"f{i}"] for i in (4, 5, 11)} == dict.fromkeys((4, 5, 11), "malformed_json")
    assert reason["f6"] == none  # what follows an object is not read
    assert [reason[f"f{i}"] for i in (7, 8, 9)] == [None] * 3 and got["f8"]["event_id"] == "7"
    assert (got["f9"]["loan_type"], got["f9"]["credit_score"], got["f9"]["interest_rate"]) == ('{"x":[1,"é"]}', 700, 0.001)
    assert (reason["f10"], reason["f12"]) == ("bad_field:days_past_due", "not_null:loan_id")
    assert reason["f13"] is None and got["f13"]["is_valid"] is True and got["f13"]["event_timestamp"] is None
    assert got["f14"]["original_balance"] is None and got["f14"]["ltv_ratio"] == 0.5
    typed = landing.extract_events(docs).collect()
    assert len(typed) == len(lines) and typed[11]["event_id"] is None and typed[7]["event_id"] == "e-1"
