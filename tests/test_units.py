"""Hand-written rows for three-valued and boundary logic (K8, K9, D11, D14,
D18, E1, E3, E5)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake import schema as S
from loanlake.functions import columns as C
from loanlake.operators import staging


def raw_row(**kw):
    base = dict(
        event_id="EV-1", loan_id="LN-1", borrower_id="BRW-1", tenant_id="mortgage_servicer_a",
        event_type=" payment ", loan_type="fha", loan_purpose="purchase",
        origination_date=dt.date(2020, 1, 31), maturity_date=dt.date(2050, 2, 1),
        original_balance=100000.0, current_balance=90000.0, interest_rate=0.05, monthly_payment=500.0,
        payment_amount=500.0, days_past_due=0, property_state="CA", credit_score=720,
        ltv_ratio=0.8, dti_ratio=0.43, event_timestamp=dt.datetime(2024, 1, 2, 3, 4, 5), is_valid=True,
        loaded_at=dt.datetime(2024, 1, 2, 4, 0, 0), batch_id="b")
    base.update(kw)
    return base


NULLABLE_RAW = T.StructType([T.StructField(f.name, f.dataType, True) for f in S.RAW_SCHEMA.fields])


def make(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in NULLABLE_RAW.fields) for r in rows], NULLABLE_RAW)


def test_delinquency_bucket_edges(spark):
    vals = [None, -5, 0, 1, 30, 31, 60, 61, 90, 91, 120, 121, 400]
    df = make(spark, [raw_row(event_id=f"EV-{i}", days_past_due=v) for i, v in enumerate(vals)])
    out = {r["event_id"]: r for r in staging.stage_loans(df).collect()}
    got = [out[f"EV-{i}"]["delinquency_bucket"] for i in range(len(vals))]
    assert got == ["SEVERE_DELINQUENCY", "30_DPD", "CURRENT", "30_DPD", "30_DPD", "60_DPD", "60_DPD",
                   "90_DPD", "90_DPD", "120_DPD", "120_DPD", "SEVERE_DELINQUENCY", "SEVERE_DELINQUENCY"]
    # K8: NULL days past due -> 0 after coalesce, but bucket SEVERE and serious flag NULL
    assert out["EV-0"]["days_past_due"] == 0
    assert out["EV-0"]["is_seriously_delinquent"] is None
    assert out["EV-9"]["is_seriously_delinquent"] is True and out["EV-8"]["is_seriously_delinquent"] is False


def test_credit_tier_edges(spark):
    vals = [None, 599, 600, 649, 650, 699, 700, 749, 750, 850]
    df = make(spark, [raw_row(event_id=f"EV-{i}", credit_score=v) for i, v in enumerate(vals)])
    out = {r["event_id"]: r["credit_tier"] for r in staging.stage_loans(df).collect()}
    assert [out[f"EV-{i}"] for i in range(len(vals))] == [
        "VERY_POOR", "VERY_POOR", "POOR", "POOR", "FAIR", "FAIR", "GOOD", "GOOD", "EXCELLENT", "EXCELLENT"]


def test_complete_record_null_balance_is_true(spark):
    rows = [raw_row(event_id="EV-a", original_balance=None),       # K9: NULL balance -> TRUE
            raw_row(event_id="EV-b", interest_rate=None),          # K9: NULL rate -> TRUE
            raw_row(event_id="EV-c", original_balance=0.0),
            raw_row(event_id="EV-d", interest_rate=0.0),
            raw_row(event_id="EV-e", borrower_id=None),
            raw_row(event_id="EV-f", origination_date=None),
            raw_row(event_id="EV-g", is_valid=False),              # C1: dropped
            raw_row(event_id="EV-h", is_valid=None)]               # C1: NULL dropped too
    out = {r["event_id"]: r["is_complete_record"] for r in staging.stage_loans(make(spark, rows)).collect()}
    assert out == {"EV-a": True, "EV-b": True, "EV-c": False, "EV-d": False, "EV-e": False, "EV-f": False}


def test_month_boundaries_and_flags(spark):
    df = make(spark, [raw_row(event_id="EV-1", origination_date=dt.date(2024, 1, 31),
                              maturity_date=dt.date(2024, 2, 1), ltv_ratio=0.80004, dti_ratio=0.43001)])
    r = staging.stage_loans(df).first()
    assert r["loan_term_months"] == 1            # boundary count, not whole months
    assert r["loan_age_years"] == 0
    assert r["ltv_ratio"] == 0.8 and r["is_high_ltv"] is True   # flag on the unrounded value
    assert r["dti_ratio"] == 0.43 and r["is_high_dti"] is True
    assert r["event_type"] == "PAYMENT" and r["loan_type"] == "FHA"


def test_payment_ratio_due_zero_and_flags(spark):
    df = spark.createDataFrame([(500.0, 0.0), (None, 500.0), (0.0, 500.0), (400.0, 500.0), (600.0, 500.0)],
                               "payment_amount double, monthly_payment double")
    flags = C.payment_flags()
    rows = df.select(C.payment_ratio().alias("r"), *[e.alias(n) for n, e in flags.items()]).collect()
    assert rows[0]["r"] is None                                  # due 0 -> NULL, no error
    assert rows[1]["is_full_payment"] is None                    # NULL paid -> NULL flags
    assert rows[2]["is_partial_payment"] is False                # paid 0 is not partial
    assert rows[3]["is_partial_payment"] is True and rows[3]["r"] == 0.8
    assert rows[4]["is_overpayment"] is True and rows[4]["is_full_payment"] is True


def test_risk_score(spark):
    df = spark.createDataFrame([(850, 0.5, 0.2, 0), (None, 0.5, 0.2, 0), (425, None, None, 30)],
                               "credit_score int, ltv_ratio double, dti_ratio double, days_past_due int")
    got = [r[0] for r in df.select(C.composite_risk_score()).collect()]
    assert got == [100.0, None, 35.0]


def test_level_payment_rate_zero(spark):
    df = spark.createDataFrame([(120000.0, 0.0, 360), (100000.0, 0.06, 360)],
                               "b double, r double, n int")
    got = [r[0] for r in df.select(C.level_payment("b", "r", "n")).collect()]
    assert got[0] == round(120000.0 / 360, 2)
    assert got[1] == 599.55
    assert df.select(C.maturity_from_term(F.lit(dt.date(2020, 1, 1)), F.lit(2))).first()[0] == dt.date(2020, 3, 1)
    assert df.select(C.clamp_credit_score(F.lit(900)), C.clamp_credit_score(F.lit(100))).first() == (850, 300)


def test_sql_views_and_upper_columns(spark):
    from loanlake.plans import views
    from loanlake.sources import fixtures
    from conftest import SF_SMALL
    raw = fixtures.loan_events(spark, SF_SMALL)
    views.register_models(spark, raw)
    n = spark.sql("select count(*) from fct_loan_portfolio where composite_risk_score is not null").first()[0]
    assert n > 0
    rep = spark.sql("""select date_trunc('hour', loaded_at) as load_hour, event_type, tenant_id, count(*) as c
                       from raw_loan_events group by 1, 2, 3 order by 1 desc, 4 desc""")
    assert rep.count() > 0
    up = views.upper_columns(raw.limit(1))
    assert up.columns[0] == "EVENT_ID" and up.select("event_id").count() == 1


def test_schema_violations_metadata_only(spark):
    from loanlake.operators import quality
    df = spark.createDataFrame([("a", 1)], "event_id string, credit_score bigint")
    got = quality.schema_violations(df, S.RAW_SCHEMA)
    kinds = {(c, k) for c, k, _ in got}
    assert ("credit_score", "type_mismatch") in kinds and ("loan_id", "missing_column") in kinds


def test_orphan_summary_with_orphans(spark):
    from loanlake.operators import quality
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)] + [(9,)] * 50, "k bigint")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "p bigint")
    r = quality.orphan_summary("c->p", child, "k", parent, "p").first()
    assert (r["child_rows"], r["orphan_rows"], r["orphan_keys"]) == (54, 51, 2)


def test_clustered_write_splits_a_hot_partition_value(spark, scratch):
    import os
    from loanlake.plans.tables import clustered
    from loanlake.sources import landing
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("date")
        .alias("event_date"), (F.col("id") % 3).cast("string").alias("tenant_id"), F.col("id").alias("loan_id"))
    out = os.path.join(scratch, "fact")
    # AQE would merge these tiny range partitions into one; at scale they stay apart.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered(df, "event_date", ["tenant_id", "loan_id"]).write.partitionBy("event_date").parquet(out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = [f for f in os.listdir(os.path.join(out, "event_date=2024-01-01")) if f.endswith(".parquet")]
    assert len(hot) > 1                                   # 90% of rows on one date: several writers
    assert spark.read.parquet(out).count() == 20000
    landing.write_scratch(df, os.path.join(scratch, "scratch"))
    landing.write_scratch(df.limit(5), os.path.join(scratch, "scratch"))   # full overwrite (A7)
    assert spark.read.parquet(os.path.join(scratch, "scratch")).count() == 5
