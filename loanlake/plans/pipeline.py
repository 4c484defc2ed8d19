"""One scheduled run, end to end.

extract (landing files not loaded yet) -> rejects -> row-count gate ->
validate -> load (merge into raw) -> staging (lazy) -> fact refresh ->
post-build tests -> audit row. Any failed stage raises and stops the chain;
the files of a run that failed before or in its load are read again by the
next one (the merge skips rows that made it).

The fact is a parquet table partitioned by event_date. The first run builds
it; later runs rewrite only the dates whose rows can change (see
``incremental.changed_partitions``), so a run's write cost follows the new
data, not the table size.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from loanlake import schema as S
from loanlake.functions.columns import ts_ntz_lit
from loanlake.operators import history, incremental, loan_state, mart_state, marts, merge, quality, staging
from loanlake.plans import schema_record
from loanlake.plans.buckets import BucketedTable
from loanlake.plans.key_index import KeyIndex
from loanlake.plans.tables import (VersionedTable, clustered, finish_swap, overwrite_partitions, read_marker,
                                   read_raw, write_marker)
from loanlake.session import ensure_checkpoint_dir
from loanlake.sources import landing


@dataclass
class PipelineConfig:
    landing_dir: str
    raw_path: str
    fact_path: str
    rejects_path: str
    audit_path: str
    layout: str = "lines"
    batch_id: str | None = None
    as_of: dt.datetime | None = None
    dim_root: str | None = None          # J6 loan dimension, kept by merge on loan_id
    raw_by_event_date: bool = False      # raw partitioned by event_date; key checks read the batch's dates
    state_root: str | None = None        # per-loan window state: refresh reads state + new rows only
    history_root: str | None = None      # Q9 versions of each loan, kept by merge
    marts_root: str | None = None        # J4, J5 and J7 from states that new events are added to
    key_index_root: str | None = None    # raw keys in hash buckets: a load reads those of its own keys
    max_reject_share: float = 0.05
    max_files: int = 10_000              # landing files of one run; later ones wait for the next
    # Event fields beyond the record, (name, DDL type); the fact follows when they come and go (H3).
    extra_fields: tuple[tuple[str, str], ...] = ()
    # Range rules that stop the run; the others are logged as warnings.
    critical_rules: tuple[str, ...] = ()
    fact_kwargs: dict = field(default_factory=dict)


class QualityGateError(RuntimeError):
    pass


def validate_batch(events, rejects, max_reject_share: float, critical_rules=()):
    """Checks before loading (K15: validation runs before the load).
    Returns (failures, warnings). A reject share above the limit and any
    violated rule listed in ``critical_rules`` fail the run; other range
    findings are warnings. NULL keys never reach here (quarantined)."""
    n_ok, n_bad = events.count(), rejects.count()
    res = quality.gate({"ranges": quality.range_violations(events)}, {"ranges": "violations"})
    failures = [f for f in res.failures if f.get("rule") in critical_rules]
    warnings = [f for f in res.failures if f.get("rule") not in critical_rules]
    total = n_ok + n_bad
    if total and n_bad / total > max_reject_share:
        failures.append({"check": "reject_share", "rejected": n_bad, "total": total})
    return failures, warnings


FACT_DOMAINS = {
    "tenant_id": S.TENANT_IDS,
    "loan_type": S.LOAN_TYPES,
    "delinquency_bucket": ["CURRENT", "30_DPD", "60_DPD", "90_DPD", "120_DPD", "SEVERE_DELINQUENCY"],
    "credit_tier": ["EXCELLENT", "GOOD", "FAIR", "POOR", "VERY_POOR"],
}


def fact_tests(fact):
    """Post-build tests on the fact (unique / not_null / accepted values)."""
    findings = {
        "unique_event_id": quality.uniqueness_summary("fact(event_id)", fact.select("event_id"), ["event_id"]),
        # an event without a timestamp is legal, so event_date may be NULL
        "not_null": quality.null_counts(fact, ["event_id", "loan_id", "borrower_id", "tenant_id"]),
        "accepted": quality.accepted_value_violations(fact, FACT_DOMAINS),
    }
    return quality.gate(findings, {"unique_event_id": "duplicate_keys", "not_null": "null_count",
                                   "accepted": "rows"})


def load_stamp(spark: SparkSession, fact_path: str, now: dt.datetime) -> dt.datetime:
    """The loaded_at for a new load: ``now``, moved just past the refresh
    watermark if the clock has not advanced beyond it, so every load is
    strictly newer than what the fact already covers."""
    mark = read_marker(spark, fact_path.rstrip("/") + "_watermark.json")
    if mark:
        floor = dt.datetime.fromisoformat(mark["loaded_at"]) + dt.timedelta(microseconds=1)
        return max(now, floor)
    return now


def refresh_step(spark: SparkSession, raw_path: str, fact_path: str, as_of: dt.datetime, batch_id: str,
                 state_root: str | None = None, extra: tuple[str, ...] = (), **fact_kwargs) -> list | None:
    """Stage the raw table and bring the fact up to date (first run: full
    build; later: only the touched event_date partitions, all of them if a
    schema change needs it), run the post-build tests on what was written,
    then move the watermark. ``extra`` names raw fields beyond the record that
    the fact carries. Returns the rewritten dates (None after a full build)."""
    raw = read_raw(spark, raw_path)
    stg = staging.stage_loans(raw, as_of=as_of, extra=tuple(c for c in extra if c in raw.columns))
    sort_cols = ["tenant_id", "loan_id"]
    watermark_path = fact_path.rstrip("/") + "_watermark.json"
    built_path = fact_path.rstrip("/") + "_built.json"
    high = loaded_up_to(spark, raw_path, raw)                # everything up to here is in the fact after this run
    state_tbl = BucketedTable(spark, state_root, "loan_id") if state_root else None
    new_state, touched = None, None
    finish_swap(spark, fact_path)                            # a run that died in its swap is completed first
    staging_dir = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fact-stage-{batch_id}-{uuid.uuid4().hex}"
    if read_marker(spark, built_path) is None:
        # H1: first run, full build; a folder left by a build that died has no marker and is replaced.
        fact = incremental.refresh_fact(stg, None, **fact_kwargs)
        clustered(fact, "event_date", sort_cols).write.mode("overwrite").partitionBy("event_date").parquet(fact_path)
        schema_record.write_record(spark, fact_path, schema_record.Record(schema_record.plain(fact.schema)))
        write_marker(spark, built_path, {"batch_id": batch_id})
        dates = None
        if state_tbl is not None:
            new_state = loan_state.initial_state(stg)
    elif state_tbl is not None and state_tbl.pointer():
        # Bounded refresh: state + new rows for in-order loans, full history
        # only for loans with late events. Only the new rows' state buckets are read and written.
        since = dt.datetime.fromisoformat(state_tbl.pointer()["loaded_at"])
        touched = state_tbl.touched(stg.filter(F.col("loaded_at") > ts_ntz_lit(since)).select("loan_id"))
        target = schema_record.read_table(spark, fact_path)
        rows, dates, new_state = loan_state.refresh_with_state(stg, target, state_tbl.read(touched), since)
        if rows is not None:
            swap_in(spark, rows, dates, target, fact_path, sort_cols, staging_dir)
    else:
        # The watermark moves only after a refresh fully succeeded, so a run
        # that died earlier is redone (idempotently) by the next one.
        mark = read_marker(spark, watermark_path)
        since = dt.datetime.fromisoformat(mark["loaded_at"]) if mark else None
        target = schema_record.read_table(spark, fact_path)
        rows, dates = incremental.changed_partitions(stg, target, since, **fact_kwargs)
        if rows is not None:
            swap_in(spark, rows, dates, target, fact_path, sort_cols, staging_dir)
        if state_tbl is not None:                            # state was asked for after the first build
            new_state = loan_state.initial_state(stg)
    fact_now = schema_record.read_table(spark, fact_path)
    if dates:
        fact_now = fact_now.filter(incremental.in_dates(dates))                 # test what was rewritten
    result = fact_tests(fact_now)
    if not result.passed:
        raise QualityGateError(f"post-build tests failed: {result.failures[:5]}")
    if high is not None:
        if new_state is not None:
            # Published last: until this pointer moves, a rerun starts from the old state.
            meta = {"loaded_at": high.isoformat(), "batch_id": batch_id}
            if touched is None:
                state_tbl.write(new_state, meta)
            else:
                state_tbl.replace(new_state, touched, meta)
        write_marker(spark, watermark_path, {"loaded_at": high.isoformat(), "batch_id": batch_id})
    return dates


def loaded_up_to(spark: SparkSession, raw_path: str, raw) -> dt.datetime | None:
    """The latest ``loaded_at`` of the raw table, as its last load noted it; the table is
    read only if none did. A load that died before its note is covered again by a later
    run: refreshing rows twice changes nothing."""
    mark = read_marker(spark, raw_path.rstrip("/") + "_loaded.json")
    if mark:
        return dt.datetime.fromisoformat(mark["loaded_at"])
    return raw.agg(F.max("loaded_at")).first()[0]


def swap_in(spark: SparkSession, rows, dates: list, target, fact_path: str, sort_cols: list[str], staging_dir: str) -> None:
    """Replace the touched partitions and publish the schema that they bring (H3)."""
    sync = schema_record.plan_sync(schema_record.read_record(spark, fact_path), rows.schema)
    if sync.rewrite:                     # the files can't express the change: every partition, once
        rest = target.filter(~F.coalesce(incremental.in_dates(dates), F.lit(False)))
        rows = schema_record.reshape(rest, sync.record.schema).unionByName(schema_record.reshape(rows, sync.record.schema))
    overwrite_partitions(spark, rows, fact_path, "event_date", sort_cols, staging_dir, record=sync.record.to_json())


def update_dimension(spark: SparkSession, raw_path: str, dim_root: str, as_of: dt.datetime) -> int:
    """Merge the events loaded since the dimension's own watermark into the
    loan dimension and publish it as a new version (the pointer carries the
    watermark, so a failed run leaves both untouched). Returns the loans."""
    table = VersionedTable(spark, dim_root)
    ptr = table.pointer()
    stg = staging.stage_loans(read_raw(spark, raw_path), as_of=as_of)
    if ptr and ptr.get("loaded_at"):
        stg = stg.filter(F.col("loaded_at") > ts_ntz_lit(dt.datetime.fromisoformat(ptr["loaded_at"])))
    high = stg.agg(F.max("loaded_at")).first()[0]
    if high is None:
        return 0
    dim = marts.merge_dimension(table.read(), stg)
    written = Observation("dimension")
    table.write(dim, meta={"loaded_at": high.isoformat()}, observation=written)
    return written.get["rows"]


def update_history(spark: SparkSession, raw_path: str, history_root: str, as_of: dt.datetime) -> int:
    """Bring the loans' versions up to date (Q9): events loaded since the history's own
    watermark are merged, only their loans' buckets are read and written. Returns the loans touched."""
    table = BucketedTable(spark, history_root, "loan_id")
    p = table.pointer()
    stg = staging.stage_loans(read_raw(spark, raw_path), as_of=as_of)
    fresh = stg.filter(F.col("loaded_at") > ts_ntz_lit(dt.datetime.fromisoformat(p["loaded_at"]))) if p else stg
    high, loans = fresh.agg(F.max("loaded_at"), F.countDistinct("loan_id")).first()
    if high is None:
        return 0
    meta = {"loaded_at": high.isoformat()}
    if p is None:
        table.write(history.build_runs(stg), meta)
    else:
        touched = table.touched(fresh.select("loan_id"))
        table.replace(history.merge_runs(table.read(touched), fresh, stg), touched, meta)
    return loans


def update_marts(spark: SparkSession, raw_path: str, marts_root: str, as_of: dt.datetime) -> None:
    """Add the events loaded since each mart's own watermark to its state (J4, J5, J7). State
    and watermark become visible together, so an event is added once."""
    stg = staging.stage_loans(read_raw(spark, raw_path), as_of=as_of)
    for name, mart in mart_state.MARTS.items():
        table = BucketedTable(spark, f"{marts_root.rstrip('/')}/{name}", "loan_id")
        p = table.pointer()
        fresh = stg.filter(F.col("loaded_at") > ts_ntz_lit(dt.datetime.fromisoformat(p["loaded_at"]))) if p else stg
        high = fresh.agg(F.max("loaded_at")).first()[0]
        if high is None:
            continue
        part, meta = mart_state.partial(fresh, mart), {"loaded_at": high.isoformat()}
        if p is None:
            table.write(part, meta)
        else:
            touched = table.touched(fresh.select("loan_id"))
            table.replace(mart_state.add(table.read(touched), part), touched, meta)


def read_mart(spark: SparkSession, marts_root: str, name: str):
    """A mart from its state, or None before the first run."""
    state = BucketedTable(spark, f"{marts_root.rstrip('/')}/{name}", "loan_id").read()
    return None if state is None else mart_state.mart_rows(state, mart_state.MARTS[name])


def loaded_files_path(raw_path: str) -> str:
    """The table of landing files whose rows the raw table holds."""
    return raw_path.rstrip("/") + "_files"


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict:
    now = load_stamp(spark, cfg.fact_path, cfg.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    batch_id = cfg.batch_id or now.strftime("%Y%m%dT%H%M%S")
    files = landing.new_files(spark, cfg.landing_dir, loaded_files_path(cfg.raw_path), cfg.max_files)
    if not files and not refresh_pending(spark, cfg):       # C6: nothing new -> skip downstream
        return {"batch_id": batch_id, "status": "skipped", "rows_inserted": 0}
    counts, warnings = load_files(spark, cfg, files, now, batch_id) if files else (
        {"batch_id": batch_id, "batch_rows": 0, "rows_inserted": 0, "rows_skipped": 0}, [])
    if not counts["batch_rows"] and not refresh_pending(spark, cfg):
        return {"batch_id": batch_id, "status": "skipped", "rows_inserted": 0}
    dates = refresh_step(spark, cfg.raw_path, cfg.fact_path, now, batch_id, state_root=cfg.state_root,
                         extra=tuple(n for n, _ in cfg.extra_fields), **cfg.fact_kwargs)
    loans = update_dimension(spark, cfg.raw_path, cfg.dim_root, now) if cfg.dim_root else None
    versions = update_history(spark, cfg.raw_path, cfg.history_root, now) if cfg.history_root else None
    if cfg.marts_root:
        update_marts(spark, cfg.raw_path, cfg.marts_root, now)
    record = schema_record.read_record(spark, cfg.fact_path)
    audit = {**counts, "status": "loaded", "files": len(files), "schema_version": record.version, "fact_dates_rewritten": len(dates) if dates is not None else -1,
             "dimension_loans": loans if loans is not None else -1,
             "history_loans": versions if versions is not None else -1,
             "run_at": now.isoformat(),
             "warnings": ";".join(f"{w['rule']}={w['violations']}" for w in warnings)}
    spark.createDataFrame([audit]).write.mode("append").json(cfg.audit_path)
    return audit


def refresh_pending(spark: SparkSession, cfg: PipelineConfig) -> bool:
    """Whether rows were loaded that no finished refresh has covered."""
    loaded = read_marker(spark, cfg.raw_path.rstrip("/") + "_loaded.json")
    covered = read_marker(spark, cfg.fact_path.rstrip("/") + "_watermark.json")
    stamp = dt.datetime.fromisoformat
    return loaded is not None and (covered is None or stamp(covered["loaded_at"]) < stamp(loaded["loaded_at"]))


def load_files(spark: SparkSession, cfg: PipelineConfig, files: list[tuple], now: dt.datetime,
               batch_id: str) -> tuple[dict, list]:
    """Parse, quarantine, check and merge landing files; (counters, warnings)."""
    # One parse pass, persisted, feeds the gate, the rejects and the load.
    docs = landing.landing_documents(spark, [f[0] for f in files], cfg.layout)
    tagged = landing.parse_tagged(docs, layout=cfg.layout, extra=cfg.extra_fields).persist()
    events, rejects = landing.split_tagged(tagged)
    try:
        rejects.write.mode("overwrite").json(f"{cfg.rejects_path}/batch={batch_id}")
        failures, warnings = validate_batch(events, rejects, cfg.max_reject_share, cfg.critical_rules)
        if failures:
            raise QualityGateError(f"{len(failures)} validation failures: {failures[:5]}")
        raw_batch = landing.apply_defaults(events, loaded_at=now, batch_id=batch_id)
        index = KeyIndex(spark, cfg.key_index_root) if cfg.key_index_root else None
        counts = merge.load_batch(spark, raw_batch, cfg.raw_path, batch_id, by_event_date=cfg.raw_by_event_date, index=index)
        landing.mark_loaded(spark, files, loaded_files_path(cfg.raw_path), batch_id)
    finally:
        tagged.unpersist()
    return counts, warnings
