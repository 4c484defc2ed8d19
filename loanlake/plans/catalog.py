"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through the fixture adapters, so its work
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.functions import columns as C
from loanlake.operators import history, incremental, loan_state, mart_state, marts, merge, quality, staging, stats, windows
from loanlake.plans import schema_record, views
from loanlake.plans.key_index import KeyIndex
from loanlake.session import ensure_checkpoint_dir
from loanlake.sources import fixtures, landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_loans(fixtures.loan_events(spark, sf_dir))


def written_once(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the checkpoint folder, for a query that reads it many
    times: each reader scans its own columns and rows of it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("stage_loans")            # C1, D1-D21
def q_stage_loans(spark, sf_dir):
    return stg(spark, sf_dir)


@register("loan_portfolio")         # G7-G13, E1-E3, C2 (event grain)
def q_loan_portfolio(spark, sf_dir):
    return marts.loan_portfolio(stg(spark, sf_dir))


@register("loan_portfolio_daily")   # F1-F2 as many-to-one left joins
def q_loan_portfolio_daily(spark, sf_dir):
    return marts.loan_portfolio_daily(stg(spark, sf_dir))


@register("stg_payments")           # J1
def q_stg_payments(spark, sf_dir):
    return marts.stg_payments(stg(spark, sf_dir))


@register("stg_delinquency")        # J2
def q_stg_delinquency(spark, sf_dir):
    return marts.stg_delinquency(stg(spark, sf_dir))


@register("loan_metrics_latest")    # J3
def q_loan_metrics_latest(spark, sf_dir):
    return marts.loan_metrics_latest(stg(spark, sf_dir))


@register("payment_agg_monthly")    # J4
def q_payment_agg_monthly(spark, sf_dir):
    return marts.payment_agg_monthly(stg(spark, sf_dir))


@register("delinquency_dashboard")  # J5
def q_delinquency_dashboard(spark, sf_dir):
    return marts.delinquency_dashboard(stg(spark, sf_dir))


@register("dim_loan_attributes")    # J6
def q_dim_loan_attributes(spark, sf_dir):
    return marts.dim_loan_attributes(stg(spark, sf_dir))


@register("executive_portfolio")    # J7
def q_executive_portfolio(spark, sf_dir):
    return marts.executive_portfolio(marts.fact_base(stg(spark, sf_dir)))   # J7 reads no window metric


# ---------------------------------------------------------------------------
# Window operators on long per-loan histories (G7-G13 + calendar variant)
# ---------------------------------------------------------------------------
HIST_ORDER = ["event_date", "tie1", "tie2", "tie3"]
HIST_KEYS = ["loan_id", "event_date", "tie1", "tie2", "tie3"]


def _hist(spark, sf_dir):
    return fixtures.loan_history(spark, sf_dir)


def _dpd_rows(*rows):
    return windows.Spec(["loan_id"], HIST_ORDER, rows=list(rows))


@register("rolling_max_dpd")        # G7-G8: 31- and 91-row max
def q_rolling_max_dpd(spark, sf_dir):
    d = F.col("days_past_due")
    out = windows.windowed(_hist(spark, sf_dir), [_dpd_rows(
        windows.Rows("max_dpd_30d", "max", d, 30), windows.Rows("max_dpd_90d", "max", d, 90))])
    return out.select(*HIST_KEYS, "days_past_due", "max_dpd_30d", "max_dpd_90d")


@register("dpd_delta")              # G9: change vs previous row, first row vs 0
def q_dpd_delta(spark, sf_dir):
    d = F.col("days_past_due")
    out = windows.windowed(_hist(spark, sf_dir), [_dpd_rows(windows.Rows("_prev", "lag", d, 1, default=0))])
    return out.select(*HIST_KEYS, "days_past_due", (d - F.col("_prev")).alias("dpd_delta"))


@register("delinquency_count")      # G10, G13: delinquent rows among the last 366
def q_delinquency_count(spark, sf_dir):
    d = F.col("days_past_due")
    out = windows.windowed(_hist(spark, sf_dir), [_dpd_rows(
        windows.Rows("delinquency_count_12m", "count", F.when(d > 0, 1), 365))])
    return out.select(*HIST_KEYS, "days_past_due", "delinquency_count_12m")


@register("payment_windows")        # G11-G12 over payment rows
def q_payment_windows(spark, sf_dir):
    pays = _hist(spark, sf_dir).filter(F.col("payment_amount").isNotNull())
    spec = marts.payment_spec(keys=("loan_id",), order=HIST_ORDER)
    out = windows.windowed(pays, [spec])
    return out.select(*HIST_KEYS, "payment_amount", "cumulative_payments", "on_time_payments_12m")


@register("rolling_max_dpd_calendar")  # calendar-day frames: 30 / 90 / 365 days
def q_rolling_max_dpd_calendar(spark, sf_dir):
    d = F.col("days_past_due")
    out = windows.calendar_windowed(_hist(spark, sf_dir), ["loan_id"], "event_date", [
        windows.Calendar("max_dpd_30d", "max", d, 30),
        windows.Calendar("max_dpd_90d", "max", d, 90),
        windows.Calendar("delinquency_count_365d", "count", F.when(d > 0, 1), 365)])
    return out.select(*HIST_KEYS, "days_past_due", "max_dpd_30d", "max_dpd_90d", "delinquency_count_365d")


@register("rolling_max_dpd_split")  # G7-G10 forced through the hot-key split path
def q_rolling_max_dpd_split(spark, sf_dir):
    d = F.col("days_past_due")
    out = windows.windowed(_hist(spark, sf_dir), [_dpd_rows(
        windows.Rows("max_dpd_30d", "max", d, 30), windows.Rows("max_dpd_90d", "max", d, 90),
        windows.Rows("_prev", "lag", d, 1, default=0),
        windows.Rows("delinquency_count_12m", "count", F.when(d > 0, 1), 365))],
        max_rows_per_key=100, chunk_rows=1000)
    return out.select(*HIST_KEYS, "days_past_due", "max_dpd_30d", "max_dpd_90d",
                      (d - F.col("_prev")).alias("dpd_delta"), "delinquency_count_12m")


@register("loan_portfolio_split")   # the fact with every loan routed as a hot key
def q_loan_portfolio_split(spark, sf_dir):
    return marts.loan_portfolio(stg(spark, sf_dir), max_rows_per_key=10, chunk_rows=500)


# ---------------------------------------------------------------------------
# Staging projections, one per operator group (D*)
# ---------------------------------------------------------------------------
STAGING_VIEWS = {
    "delinquency_bucket": ["event_id", "days_past_due", "delinquency_bucket", "is_seriously_delinquent"],  # D10-D12
    "credit_tier": ["event_id", "credit_score", "credit_tier"],                                            # D13-D14
    "ltv_dti_flags": ["event_id", "ltv_ratio", "ltv_pct", "is_high_ltv", "dti_ratio", "dti_pct",
                      "is_high_dti"],                                                                      # D15-D16
    "loan_term_age": ["event_id", "origination_date", "maturity_date", "loan_term_months",
                      "loan_age_years"],                                                                   # D3-D5
    "principal_paid": ["event_id", "original_balance", "current_balance", "principal_paid",
                       "pct_principal_paid", "interest_rate", "interest_rate_pct"],                        # D6-D9
    "complete_record": ["event_id", "loan_id", "borrower_id", "is_complete_record"],                       # D18
    "event_calendar": ["event_id", "event_type", "loan_type", "loan_purpose", "event_timestamp",
                       "event_date", "event_month"],                                                       # D2, D20-D21
}


def _staging_view(cols):
    return lambda spark, sf_dir: stg(spark, sf_dir).select(*cols)


for _name, _cols in STAGING_VIEWS.items():
    register(_name)(_staging_view(_cols))


# ---------------------------------------------------------------------------
# Scalar formulas
# ---------------------------------------------------------------------------
@register("risk_score")             # E3 on every staging row
def q_risk_score(spark, sf_dir):
    return stg(spark, sf_dir).select("event_id", C.composite_risk_score().alias("composite_risk_score"))


@register("amortised_payment")      # E5
def q_amortised_payment(spark, sf_dir):
    return stg(spark, sf_dir).select(
        "event_id", C.level_payment("original_balance", "interest_rate", "loan_term_months").alias("level_payment"))


@register("remaining_balance")      # E6 (months elapsed up to the event)
def q_remaining_balance(spark, sf_dir):
    s = stg(spark, sf_dir)
    elapsed = C.month_boundaries("origination_date", "event_date")
    return s.select("event_id", C.linear_remaining_balance("original_balance", elapsed, "loan_term_months")
                    .alias("linear_balance"))


@register("maturity_date")          # E7
def q_maturity_date(spark, sf_dir):
    return stg(spark, sf_dir).select(
        "event_id", C.maturity_from_term("origination_date", "loan_term_months").alias("maturity_30d"))


@register("clamp_score")            # E8
def q_clamp_score(spark, sf_dir):
    raw = fixtures.loan_events(spark, sf_dir)
    return raw.select("event_id", C.clamp_credit_score("credit_score").alias("credit_score_clamped"))


# ---------------------------------------------------------------------------
# Ingestion: encode, parse, quarantine, merge
# ---------------------------------------------------------------------------
CUT = dt.datetime(2024, 1, 15, 12, 0, 0)


def _raw(spark, sf_dir):
    return fixtures.loan_events(spark, sf_dir)


def _roundtrip(spark, sf_dir):
    msgs = landing.publish_records(_raw(spark, sf_dir))
    docs = msgs.select(F.col("value").alias("doc"), F.col("key").alias("source"))
    return landing.parse_documents(docs)


@register("event_json_roundtrip")   # B5 encode -> A4/B1 parse + try_cast, NOT NULL quarantine
def q_event_json_roundtrip(spark, sf_dir):
    events, _ = _roundtrip(spark, sf_dir)
    return events


@register("quarantine_rejects")     # A2, A8: rejected records with reasons
def q_quarantine_rejects(spark, sf_dir):
    _, rejects = _roundtrip(spark, sf_dir)
    return rejects.select(F.get_json_object("record", "$.event_id").alias("event_id"), "reason")


@register("publish_records")        # A1 encoding: key = tenant, value = JSON
def q_publish_records(spark, sf_dir):
    return landing.publish_records(_raw(spark, sf_dir))


def _before_cut(df):
    return df.filter(F.col("loaded_at") < C.ts_ntz_lit(CUT))


def _replayed_batch(raw):
    """All events plus a second copy of those loaded from the cut on, loaded
    one day later with a corrected balance (a replayed, amended delivery)."""
    late = raw.filter(F.col("loaded_at") >= C.ts_ntz_lit(CUT))
    copies = (late.withColumn("loaded_at", F.col("loaded_at") + F.expr("INTERVAL 1 DAY"))
              .withColumn("current_balance", F.col("current_balance") - 1.0))
    return raw.unionByName(copies)


@register("merge_insert_new_events")  # only keys absent from the target
def q_merge_insert_new_events(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    inserts, _ = merge.merge_insert(raw, _before_cut(raw))
    return inserts


@register("merge_insert_by_key_index")  # F3/H4: the same rows, the target's keys looked up in hash buckets
def q_merge_insert_by_key_index(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/keys-{uuid.uuid4().hex}"
    index = KeyIndex(spark, root, bucket_keys=1000)
    index.build(_before_cut(raw))
    return merge.new_rows(merge.dedup_latest(raw), index.known(raw))


@register("unloaded_files")         # A6: landing files by path, length and time against the load history
def q_unloaded_files(spark, sf_dir):
    raw = _raw(spark, sf_dir)

    def files(events):
        """The landing files that hold these events: one per day and tenant."""
        name = F.concat(F.lit("ds="), F.col("event_timestamp").cast("date").cast("string"), F.lit("/"), F.col("tenant_id"))
        return events.groupBy(name.alias("file")).agg(
            F.sum(F.octet_length("event_id") + F.octet_length("loan_id")).cast("long").alias("length"), F.max("loaded_at").alias("modified"))

    return landing.unloaded(files(raw), files(_before_cut(raw)))


@register("dedup_latest_event")     # F4: one row per event_id, latest copy wins
def q_dedup_latest_event(spark, sf_dir):
    return merge.dedup_latest(_replayed_batch(_raw(spark, sf_dir)))


@register("load_counts")            # F5: batch rows, inserted, skipped
def q_load_counts(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    _, audit = merge.merge_insert(_replayed_batch(raw), _before_cut(raw))
    return audit


# ---------------------------------------------------------------------------
# Load report
# ---------------------------------------------------------------------------
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


@register("load_stats_24h")         # last 24 hours before as_of
def q_load_stats_24h(spark, sf_dir):
    return stats.hourly_load_stats(_raw(spark, sf_dir), as_of=AS_OF)


@register("load_stats_hourly")      # every hour of the raw table
def q_load_stats_hourly(spark, sf_dir):
    return stats.hourly_load_stats(_raw(spark, sf_dir))


# ---------------------------------------------------------------------------
# Incremental
# ---------------------------------------------------------------------------
@register("incremental_new_rows")   # C5: event_date > MAX(target.event_date)
def q_incremental_new_rows(spark, sf_dir):
    s = stg(spark, sf_dir)
    target = marts.fact_base(_before_cut(s))                 # the bound needs no window column
    return incremental.new_since_max_date(s, target)


@register("incremental_fact_refresh")  # H1 + K1-K3 fixed: refresh == full build
def q_incremental_fact_refresh(spark, sf_dir):
    s = stg(spark, sf_dir)
    target = marts.loan_portfolio(_before_cut(s))
    cut_mark = _before_cut(s).agg(F.max("loaded_at")).first()[0]
    return incremental.refresh_fact(s, target, since=cut_mark)


def _with_channel(df):
    """Staging with a field that only events loaded from the cut on carry."""
    return df.withColumn("channel", F.when(F.col("loaded_at") >= C.ts_ntz_lit(CUT), F.lower("event_type")))


def _older_fact(before):
    """The fact as an earlier release wrote it: without the field, with a
    narrower score and with a column that is gone since."""
    ensure_checkpoint_dir(before.sparkSession)
    fact = marts.loan_portfolio(before).drop("channel").withColumn("credit_score", F.col("credit_score").cast("smallint"))
    return fact.withColumn("legacy_flag", F.lit(True)).checkpoint()


def _swapped(target, rows, dates):
    rest = target.filter(~F.coalesce(incremental.in_dates(dates), F.lit(False)))
    return schema_record.reshape(rest, rows.schema).unionByName(rows)


@register("schema_sync_refresh")    # H3: added, dropped and widened column in a partition refresh == full build
def q_schema_sync_refresh(spark, sf_dir):
    s = _with_channel(stg(spark, sf_dir))
    target = _older_fact(_before_cut(s))
    since = _before_cut(s).agg(F.max("loaded_at")).first()[0]
    rows, dates = incremental.changed_partitions(s, target, since)
    return _swapped(target, rows, dates)


@register("schema_sync_state_refresh")  # H3 in a refresh from per-loan state
def q_schema_sync_state_refresh(spark, sf_dir):
    s = written_once(_with_channel(stg(spark, sf_dir)))
    target, state = _older_fact(_before_cut(s)), loan_state.initial_state(_before_cut(s)).checkpoint()
    since = _before_cut(s).agg(F.max("loaded_at")).first()[0]
    rows, dates, _ = loan_state.refresh_with_state(s, target, state, since)
    return _swapped(target, rows, dates)


LATEST_COLS = ["loan_id", "event_timestamp", "event_id", "current_balance", "days_past_due", "delinquency_bucket"]


@register("upsert_latest_per_loan")  # H2 + H3 schema sync
def q_upsert_latest_per_loan(spark, sf_dir):
    s = stg(spark, sf_dir)
    order = ["event_timestamp", "event_id"]
    target = incremental.latest_per_key(_before_cut(s).select(*LATEST_COLS), "loan_id", order) \
        .withColumn("legacy_flag", F.lit(True))
    source = s.filter(F.col("loaded_at") >= C.ts_ntz_lit(CUT)).select(*LATEST_COLS)
    return incremental.upsert(target, source, "loan_id", order)


# ---------------------------------------------------------------------------
# Quality (Q1-Q8), history and masking (Q9-Q10)
# ---------------------------------------------------------------------------
@register("check_varchar_lengths")  # Q1 data part
def q_check_varchar_lengths(spark, sf_dir):
    return quality.length_violations(_raw(spark, sf_dir))


@register("check_nulls")            # Q2
def q_check_nulls(spark, sf_dir):
    return quality.null_counts(_raw(spark, sf_dir))


@register("check_ranges")           # Q3
def q_check_ranges(spark, sf_dir):
    return quality.range_violations(_raw(spark, sf_dir))


RELATIONSHIPS = [
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
]


@register("check_relationships")    # Q4
def q_check_relationships(spark, sf_dir):
    out = None
    for name, child, ck, parent, pk in RELATIONSHIPS:
        r = quality.orphan_summary(name, fixtures.read_table(spark, sf_dir, child, [ck]), ck,
                                   fixtures.read_table(spark, sf_dir, parent, [pk]), pk)
        out = r if out is None else out.unionByName(r)
    return out


@register("check_unique")           # Q5 summary
def q_check_unique(spark, sf_dir):
    li = fixtures.read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    od = fixtures.read_table(spark, sf_dir, "orders", ["o_orderkey"])
    ev = _raw(spark, sf_dir).select("event_id")
    return (quality.uniqueness_summary("lineitem(l_orderkey,l_linenumber)", li, ["l_orderkey", "l_linenumber"])
            .unionByName(quality.uniqueness_summary("orders(o_orderkey)", od, ["o_orderkey"]))
            .unionByName(quality.uniqueness_summary("loan_events(event_id)", ev, ["event_id"])))


@register("unique_violations")      # Q5 detail
def q_unique_violations(spark, sf_dir):
    li = fixtures.read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@register("check_accepted_values")  # Q6 (raw values, before cleaning)
def q_check_accepted_values(spark, sf_dir):
    return quality.accepted_value_violations(_raw(spark, sf_dir))


@register("freshness")              # Q7
def q_freshness(spark, sf_dir):
    return quality.freshness(_raw(spark, sf_dir), AS_OF)


@register("volume_anomaly")         # Q8
def q_volume_anomaly(spark, sf_dir):
    return quality.volume_anomalies(_raw(spark, sf_dir))


@register("scd2_history")           # Q9
def q_scd2_history(spark, sf_dir):
    return history.scd2(stg(spark, sf_dir))


@register("history_merge")          # Q9 kept by merge: stored runs + later events == scd2 over all rows
def q_history_merge(spark, sf_dir):
    s = stg(spark, sf_dir)
    runs = history.build_runs(_before_cut(s)).checkpoint()
    return history.versions(history.merge_runs(runs, s.filter(F.col("loaded_at") >= C.ts_ntz_lit(CUT)), s))


def _mart_refreshed(s, name):
    """A mart from the state of the events before the cut, with the later ones added."""
    mart = mart_state.MARTS[name]
    state = mart_state.partial(_before_cut(s), mart)
    later = mart_state.partial(s.filter(F.col("loaded_at") >= C.ts_ntz_lit(CUT)), mart)
    return mart_state.mart_rows(mart_state.add(state, later), mart)


@register("payment_agg_monthly_refresh")  # J4 kept run by run == full build
def q_payment_agg_monthly_refresh(spark, sf_dir):
    return _mart_refreshed(stg(spark, sf_dir), "payment_agg_monthly")


@register("delinquency_dashboard_refresh")  # J5, distinct loans included
def q_delinquency_dashboard_refresh(spark, sf_dir):
    return _mart_refreshed(stg(spark, sf_dir), "delinquency_dashboard")


@register("executive_portfolio_refresh")  # J7
def q_executive_portfolio_refresh(spark, sf_dir):
    return _mart_refreshed(stg(spark, sf_dir), "executive_portfolio")


@register("masked_borrowers")       # Q10
def q_masked_borrowers(spark, sf_dir):
    return history.mask_borrowers(_raw(spark, sf_dir).select("event_id", "loan_id", "borrower_id"))


@register("loan_portfolio_daily_split")  # F1-F2 form with every loan routed as a hot key
def q_loan_portfolio_daily_split(spark, sf_dir):
    return marts.loan_portfolio_daily(stg(spark, sf_dir), max_rows_per_key=10, chunk_rows=500)


@register("rolling_max_dpd_calendar_split")  # calendar frames via per-day subtotals for every loan
def q_rolling_max_dpd_calendar_split(spark, sf_dir):
    d = F.col("days_past_due")
    out = windows.calendar_windowed(_hist(spark, sf_dir), ["loan_id"], "event_date", [
        windows.Calendar("max_dpd_30d", "max", d, 30),
        windows.Calendar("max_dpd_90d", "max", d, 90),
        windows.Calendar("delinquency_count_365d", "count", F.when(d > 0, 1), 365)], max_rows_per_key=100)
    return out.select(*HIST_KEYS, "days_past_due", "max_dpd_30d", "max_dpd_90d", "delinquency_count_365d")


@register("incremental_partition_refresh")  # touched event_date partitions == full build on those dates
def q_incremental_partition_refresh(spark, sf_dir):
    s = stg(spark, sf_dir)
    target = marts.loan_portfolio(_before_cut(s))
    since = target.agg(F.max("loaded_at")).first()[0]
    rows, _ = incremental.changed_partitions(s, target, since)
    return rows


@register("json_extract_cast")      # B1: path extraction + try_cast of every event field
def q_json_extract_cast(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return landing.extract_events(raw.select(landing.to_event_json(raw).alias("doc")))


@register("payment_flags")          # E1-E2 on every staging row
def q_payment_flags(spark, sf_dir):
    return stg(spark, sf_dir).select("event_id", "payment_amount", "monthly_payment",
                                     C.payment_ratio().alias("payment_ratio"),
                                     *[e.alias(n) for n, e in C.payment_flags().items()])


@register("dimension_merge")        # J6 kept by merge on loan_id: previous dimension + later events
def q_dimension_merge(spark, sf_dir):
    s = stg(spark, sf_dir)
    previous = marts.dim_loan_attributes(_before_cut(s))
    later = s.filter(F.col("loaded_at") >= C.ts_ntz_lit(CUT))
    return marts.merge_dimension(previous, later)


def _refreshed_from_state(s, before):
    """The fact after a state refresh, from the fact and state of a previous run."""
    ensure_checkpoint_dir(s.sparkSession)
    target = marts.loan_portfolio(before).checkpoint()
    state = loan_state.initial_state(before).checkpoint()
    since = before.agg(F.max("loaded_at")).first()[0]
    rows, dates, _ = loan_state.refresh_with_state(s, target, state, since)
    return target.filter(~F.coalesce(incremental.in_dates(dates), F.lit(False))).unionByName(rows)


@register("incremental_state_refresh")  # bounded refresh from per-loan state: refreshed fact == full build
def q_incremental_state_refresh(spark, sf_dir):
    s = written_once(stg(spark, sf_dir))
    return _refreshed_from_state(s, _before_cut(s))


@register("portfolio_by_bucket_sql")  # SQL text over the registered model views (A9, A11)
def q_portfolio_by_bucket_sql(spark, sf_dir):
    views.register_models(spark, _raw(spark, sf_dir))
    return spark.sql("""
        select f.tenant_id, f.delinquency_bucket, count(distinct f.loan_id) as loans,
               max(f.max_dpd_90d) as worst_dpd, count(p.event_id) as payments
        from fct_loan_portfolio f left join stg_payments p on f.event_id = p.event_id
        group by f.tenant_id, f.delinquency_bucket""")


# ---------------------------------------------------------------------------
# NULL keys and dates, amounts in cents: every path gives the same bits
# ---------------------------------------------------------------------------
CENT_KEYS = ["loan_id", "event_date", "tie1", "tie2", "payment_amount"]


def _cents(spark, sf_dir, **kw):
    spec = marts.payment_spec(keys=("loan_id",), order=["event_date", "tie1", "tie2", "payment_amount"])
    out = windows.windowed(fixtures.payments_in_cents(spark, sf_dir), [spec], **kw)
    return out.select(*CENT_KEYS, "cumulative_payments", "on_time_payments_12m")


@register("payment_windows_cents")  # G11-G12
def q_payment_windows_cents(spark, sf_dir):
    return _cents(spark, sf_dir)


@register("payment_windows_cents_split")  # G11-G12, every loan a hot key
def q_payment_windows_cents_split(spark, sf_dir):
    return _cents(spark, sf_dir, max_rows_per_key=100, chunk_rows=1000)


def _undated(spark, sf_dir):
    return staging.stage_loans(fixtures.undated_events(spark, sf_dir))


@register("incremental_undated_refresh")  # H1 with NULL timestamps: refresh == full build
def q_incremental_undated_refresh(spark, sf_dir):
    s = _undated(spark, sf_dir)
    before = _before_cut(s)
    target = marts.loan_portfolio(before)
    rows, dates = incremental.changed_partitions(s, target, before.agg(F.max("loaded_at")).first()[0])
    return target.filter(~F.coalesce(incremental.in_dates(dates), F.lit(False))).unionByName(rows)


@register("incremental_undated_state")  # the same from per-loan state
def q_incremental_undated_state(spark, sf_dir):
    s = written_once(_undated(spark, sf_dir))
    before = _before_cut(s)
    return _refreshed_from_state(s, before)


@register("upper_case_names")       # B2
def q_upper_case_names(spark, sf_dir):
    return views.upper_columns(stg(spark, sf_dir).select("event_id", "loan_id", "delinquency_bucket"))


@register("raw_audit_columns")      # A8, B3: defaults and audit columns of a load
def q_raw_audit_columns(spark, sf_dir):
    events = _raw(spark, sf_dir).drop("loaded_at", "days_past_due")
    return landing.apply_defaults(events, AS_OF, "batch-1")


@register("replayed_merge")         # H4: a batch merged again inserts nothing
def q_replayed_merge(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    inserts, _ = merge.merge_insert(raw, _before_cut(raw))
    _, audit = merge.merge_insert(raw, _before_cut(raw).select("event_id").unionByName(inserts.select("event_id")))
    return audit


@register("empty_batch_counts")     # C7: an empty batch gives zeros
def q_empty_batch_counts(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    _, audit = merge.merge_insert(raw.filter(F.col("event_id").isNull()), raw)
    return audit


@register("check_orphans")          # Q4 with a parent table that lacks every seventh key
def q_check_orphans(spark, sf_dir):
    parent = fixtures.read_table(spark, sf_dir, "customer", ["c_custkey"]).filter("c_custkey % 7 <> 0")
    return quality.orphan_summary("orders.o_custkey->customer", fixtures.read_table(spark, sf_dir, "orders", ["o_custkey"]),
                                  "o_custkey", parent, "c_custkey")


@register("freshness_stale")        # Q7 seen a month later: the stale branch
def q_freshness_stale(spark, sf_dir):
    return quality.freshness(_raw(spark, sf_dir), AS_OF + dt.timedelta(days=60))
