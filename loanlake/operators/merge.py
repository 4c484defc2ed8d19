"""Exactly-once loading into the raw table.

Insert-only merge keyed by ``event_id``: rows whose key is already in the
target are skipped, matched rows are never touched. Duplicate keys inside one
batch are collapsed first (the latest copy wins) with a max(struct(...))
aggregate, which combines map-side, so a key repeated a billion times is
reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake import schema as S

# Batches whose keys take up to this many bytes probe the target through a
# broadcast hash of their keys; larger ones use a shuffled anti-join.
BROADCAST_BATCH_BYTES = 64 << 20


def _dedup_counted(batch: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    rest = [c for c in batch.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_b")
    return (batch.groupBy(key).agg(best, F.count(F.lit(1)).alias("_copies"))
            .select(key, *[F.col(f"_b.{c}").alias(c) for c in (*order, *rest)], "_copies")
            .select(*batch.columns, "_copies"))


def dedup_latest(batch: DataFrame, key: str = "event_id",
                 order: tuple[str, ...] = ("event_timestamp", "loaded_at")) -> DataFrame:
    """One row per key: the greatest (order..., remaining columns) wins, so
    the choice is deterministic even between identical timestamps (F4)."""
    return _dedup_counted(batch, key, order).drop("_copies")


def new_rows(batch: DataFrame, target_keys: DataFrame, key: str = "event_id",
             batch_key_bytes: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``target_keys``.

    The target can be huge and the batch small: when the batch keys are
    known to take under BROADCAST_BATCH_BYTES, the target is first cut down to
    the keys it shares with the batch (semi-join against the broadcast batch
    keys, so the target is streamed, never shuffled), and the batch is then
    anti-joined against that small match set.
    """
    tk = target_keys.select(key)
    if batch_key_bytes is not None and batch_key_bytes <= BROADCAST_BATCH_BYTES:
        matched = tk.join(F.broadcast(batch.select(key)), key, "left_semi")
        return batch.join(matched, key, "left_anti")
    return batch.join(tk, key, "left_anti")


def merge_insert(batch: DataFrame, target: DataFrame, key: str = "event_id",
                 dedup: bool = True) -> tuple[DataFrame, DataFrame]:
    """Return (rows to append, one-row audit frame) for an insert-only merge.

    The audit frame has ``batch_rows, rows_inserted, rows_skipped`` (F5):
    skipped = batch rows - inserted, covering in-batch duplicates and keys
    already loaded.
    """
    counted = (_dedup_counted(batch, key, ("event_timestamp", "loaded_at")) if dedup
               else batch.withColumn("_copies", F.lit(1).cast("bigint")))
    # One join tells new keys from known ones; counters and inserts both read it.
    known = target.select(F.col(key).alias("_known")).distinct()
    tagged = counted.join(known, F.col(key) == F.col("_known"), "left")
    zero = F.lit(0).cast("bigint")
    audit = (tagged.agg(F.sum("_copies").alias("batch_rows"), F.count(F.when(F.col("_known").isNull(), 1)).alias("rows_inserted"))
             .select(F.coalesce("batch_rows", zero).alias("batch_rows"), F.coalesce("rows_inserted", zero).alias("rows_inserted"))
             .withColumn("rows_skipped", F.col("batch_rows") - F.col("rows_inserted")))
    src = dedup_latest(batch, key) if dedup else batch
    return new_rows(src, target, key), audit


def _record_raw(spark, path: str, batch: DataFrame) -> None:
    """Widen the raw table's schema record by the batch's extra fields, before
    their first file is written. The raw table only grows: no column is dropped."""
    from loanlake.plans.schema_record import Record, plain, plan_sync, read_record, write_record
    from loanlake.plans.tables import read_marker
    names = [f.name for f in S.RAW_SCHEMA.fields]
    recorded = read_marker(spark, path.rstrip("/") + "_schema.json") is not None
    old = read_record(spark, path) if recorded else Record(plain(S.RAW_SCHEMA))
    extra = [f for f in batch.schema.fields if f.name not in names]
    if not recorded and not extra:
        return
    both = T.StructType(old.schema.fields + [f for f in extra if f.name not in old.schema.names])
    mine = {f.name: f for f in extra}
    sync = plan_sync(old, T.StructType([mine.get(f.name, f) for f in both.fields]))
    if sync.rewrite:
        raise ValueError(f"the raw table holds another type of {list(sync.retyped)}")
    if sync.changed:
        write_record(spark, path, sync.record)


def _note_load(spark, path: str, high) -> None:
    """Note the latest ``loaded_at`` beside the raw table, so that nobody has to read it for that."""
    from loanlake.plans.tables import read_marker, write_marker
    marker = path.rstrip("/") + "_loaded.json"
    known = read_marker(spark, marker)
    if high is not None and (known is None or known["loaded_at"] < high.isoformat()):
        write_marker(spark, marker, {"loaded_at": high.isoformat()})


def load_batch(spark, batch: DataFrame, target_path: str, batch_id: str,
               by_event_date: bool = False, index=None) -> dict:
    """Append the new rows of ``batch`` to the raw table at ``target_path``
    and return the load counters. Empty batch -> zeros without a write (C7).
    Replaying a batch inserts nothing (H4). Counters come from observed
    metrics of the jobs that do the work, not from extra scans.

    ``by_event_date``: the raw table is partitioned by event_date and the
    key check reads only the partitions of the batch's own event dates
    (pruned at file listing). Exact when a re-delivered event keeps its
    event_timestamp - the date is part of the event, not of the delivery.
    Without it every target event_id is checked.

    ``index`` (a ``KeyIndex``): the key check reads the buckets of the batch's own
    keys, in either layout and whatever timestamp a key comes back with.
    """
    if batch.isEmpty():
        return {"batch_id": batch_id, "batch_rows": 0, "rows_inserted": 0, "rows_skipped": 0}
    from loanlake.plans.tables import exists, read_or_empty, read_raw
    seen, wrote = Observation("batch"), Observation("inserted")
    src = dedup_latest(batch.observe(seen, F.count(F.lit(1)).alias("n"))).persist()
    try:
        known = None
        if index is not None:
            index.recover(read_raw(spark, target_path) if exists(spark, target_path) else None)
            known = index.known(src.select("event_id"))
        key_bytes = src.agg(F.sum(F.octet_length("event_id") + 16)).first()[0] or 0
        cols = [f.name for f in S.RAW_SCHEMA.fields]
        cols += [c for c in batch.columns if c not in cols]
        _record_raw(spark, target_path, batch)
        if by_event_date:
            src_d = src.withColumn("event_date", F.col("event_timestamp").cast("date"))
            # Distinct dates of one batch: bounded by the calendar.
            if known is None:
                dates = [r[0] for r in src_d.select("event_date").distinct().collect()]
                target = read_or_empty(spark, target_path, S.RAW_SCHEMA_BY_DATE)
                in_dates = F.col("event_date").isin([d for d in dates if d is not None])
                if None in dates:
                    in_dates = in_dates | F.col("event_date").isNull()
                known, known_bytes = target.filter(in_dates), key_bytes
            else:
                known_bytes = None
            inserts = (new_rows(src_d, known, batch_key_bytes=known_bytes)
                       .withColumn("batch_id", F.lit(batch_id)).select(*cols, "event_date"))
            writer = inserts.observe(wrote, F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("high")).write.mode("append") \
                .partitionBy("event_date")
        else:
            known_bytes = key_bytes if known is None else None
            known = read_or_empty(spark, target_path, S.RAW_SCHEMA) if known is None else known
            inserts = (new_rows(src, known, batch_key_bytes=known_bytes)
                       .withColumn("batch_id", F.lit(batch_id)).select(*cols))
            writer = inserts.observe(wrote, F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("high")).write.mode("append")
        if index is not None:
            index.begin(batch_id)
        writer.parquet(target_path)
        if index is not None:
            index.add(src.select("event_id").join(known, "event_id", "left_anti"), wrote.get["n"])
            index.finish()
    finally:
        src.unpersist()
    n_batch, n_ins = seen.get["n"], wrote.get["n"]
    if n_ins:
        _note_load(spark, target_path, wrote.get["high"])
    return {"batch_id": batch_id, "batch_rows": n_batch, "rows_inserted": n_ins,
            "rows_skipped": n_batch - n_ins}
