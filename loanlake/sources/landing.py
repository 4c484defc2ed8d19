"""Landing files, message encoding and the dead-letter sink.

Landing layout written here is JSON Lines under ``ds=<date>`` folders: lines
split across tasks, unlike one big JSON array. An array file (one JSON array per
file, the upstream producer's layout) is read by one task and taken apart
element by element, up to the 2 GB a string can hold.

Parsing never trusts a document: ``try_parse_json`` yields NULL for malformed
text and for duplicate object keys, and such documents are quarantined whole.
Fields are read as text, all in one pass, and typed once with ``try_cast``, so
one bad field rejects only its own row, never its siblings.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake import schema as S
from loanlake.functions.columns import ts_ntz_lit

JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


# ---------------------------------------------------------------------------
# Encoding (B5, A1)
# ---------------------------------------------------------------------------

def to_event_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Struct -> JSON object; NULL fields are written as null, not dropped."""
    cols = columns or [c for c in S.EVENT_COLUMNS if c in df.columns]
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def publish_records(df: DataFrame) -> DataFrame:
    """Message form of events: key = tenant_id (per-tenant order on the bus),
    value = the JSON object. Feed to ``write.format('kafka')`` with
    ``kafka.acks=all`` and ``kafka.compression.type=gzip`` where the Kafka
    connector is installed."""
    return df.select(F.col("tenant_id").alias("key"), to_event_json(df).alias("value"))


# ---------------------------------------------------------------------------
# Decoding (A4, B1, A8)
# ---------------------------------------------------------------------------

def _texts(doc: Column, fields: list[tuple[str, T.DataType]]) -> Column:
    """The fields of a JSON object's text as a struct of texts; NULL for other JSON."""
    is_object = F.startswith(F.ltrim(doc, F.lit(" \t\r\n")), F.lit("{"))
    return F.when(is_object, F.from_json(doc, T.StructType([T.StructField(n, T.StringType()) for n, _ in fields])))


def _typed(name: str, typ: T.DataType) -> Column:
    """A field's text typed with try_cast (NULL on bad input)."""
    raw = F.col(f"_s_{name}")
    return (raw if isinstance(typ, T.StringType) else raw.try_cast(typ)).alias(name)


def extract_events(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """B1 on its own: JSON object text -> the 21 typed event fields (NULL
    where a field is missing, malformed or fails its cast); no quarantine."""
    good = F.when(F.try_parse_json(F.col(doc_col)).isNotNull(), F.col(doc_col))
    text = docs.select(F.inline(F.array(F.struct(_texts(good, S.EVENT_FIELDS).alias("_e")))))
    return text.select(*[F.col("_e")[n].alias(f"_s_{n}") for n, _ in S.EVENT_FIELDS]).select(*[_typed(n, t) for n, t in S.EVENT_FIELDS])


def parse_tagged(docs: DataFrame, doc_col: str = "doc", source_col: str = "source",
                 layout: str = "lines", extra: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Parse JSON documents into one frame of (source, record, reason, 21
    typed event fields, the ``extra`` ones); ``reason`` is NULL for a loadable event.

    ``layout='lines'``: one event object per document; ``'array'``: one JSON
    array of events per document, taken apart into the text of its elements.
    Each event is parsed once into a VARIANT; the one-element explode is a
    plan boundary that keeps the optimizer from copying the parse into every
    later field check. One projection gives events and rejects: rejected
    documents or elements carry the source, the raw text and a reason.
    """
    # The text reader keeps invalid UTF-8 bytes as they are: such a document
    # is rejected, not silently repaired.
    utf8_ok = F.is_valid_utf8(F.col(doc_col))
    whole = docs.select(F.col(source_col).alias("source"), F.col(doc_col).alias("_doc"),
                        F.when(~utf8_ok, F.lit("invalid_utf8")).alias("_bad"))
    if layout == "array":
        # An array is taken apart as text first: no VARIANT has to hold a whole file.
        is_array = F.startswith(F.ltrim("_doc", F.lit(" \t\r\n")), F.lit("["))
        parts = F.when(F.col("_bad").isNull() & is_array, F.from_json("_doc", "array<string>"))
        one = F.struct(F.col("_doc").alias("_e"), F.coalesce("_bad", F.when(
            ~is_array & F.try_parse_json("_doc").isNotNull(), F.lit("not_an_array")).otherwise(F.lit("malformed_json"))).alias("_bad"))
        each = F.transform(parts, lambda e: F.struct(F.coalesce(e, F.lit("null")).alias("_e"), F.lit(None).cast("string").alias("_bad")))
        # the document itself must not ride along with each of its elements
        whole = whole.select("source", F.inline(F.coalesce(each, F.array(one)))).withColumnRenamed("_e", "_doc")
    fields = S.EVENT_FIELDS + S.extra_fields(extra)
    # inline() of a one-row array is a plan boundary: the document is parsed once, and
    # what leaves are plain attributes, so the casts and checks below stay small.
    bad_doc = F.coalesce("_bad", F.when(F.try_parse_json("_doc").isNull(), F.lit("malformed_json"))).alias("_bad_doc")
    rows = whole.select("source", F.col("_doc").alias("_record"), F.inline(F.array(F.struct(
        bad_doc, F.when(F.col("_bad").isNull(), _texts(F.col("_doc"), fields)).alias("_e")))))
    text = rows.select("source", "_record", "_bad_doc", *[
        F.when(F.col("_bad_doc").isNull(), F.col("_e")[n]).alias(f"_s_{n}") for n, _ in fields])
    # A second boundary: each field is cast once; whether it had a text goes along.
    cast = [n for n, typ in fields if not isinstance(typ, T.StringType)]
    once = text.select("source", "_record", "_bad_doc", F.inline(F.array(F.struct(
        *[F.col(f"_s_{n}").isNotNull().alias(f"_h_{n}") for n in cast], *[_typed(n, t) for n, t in fields]))))
    bad_arr = F.array_compact(F.array(*[F.when(F.col(f"_h_{n}") & F.col(n).isNull(), F.lit(n)) for n in cast]))
    null_arr = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in S.NOT_NULL_COLUMNS]))
    reason = (F.when(F.col("_bad_doc").isNotNull(), F.col("_bad_doc"))
              .when(F.size(bad_arr) > 0, F.concat(F.lit("bad_field:"), F.array_join(bad_arr, ",")))
              .when(F.size(null_arr) > 0, F.concat(F.lit("not_null:"), F.array_join(null_arr, ","))))
    # A third one for the reason, which filters read.
    typed = once.select("source", "_record", *[n for n, _ in fields], F.inline(F.array(F.struct(reason.alias("reason")))))
    return typed.select("source", F.col("_record").alias("record"), "reason", *[n for n, _ in fields])


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of a tagged parse; persist ``tagged`` first to split
    one parse pass into both outputs."""
    events = tagged.filter(F.col("reason").isNull()).drop("source", "record", "reason")
    rejects = tagged.filter(F.col("reason").isNotNull()).select("source", "record", "reason")
    return events, rejects


def parse_documents(docs: DataFrame, doc_col: str = "doc", source_col: str = "source",
                    layout: str = "lines") -> tuple[DataFrame, DataFrame]:
    """Parse JSON documents into typed events and rejects (see
    ``parse_tagged``)."""
    return split_tagged(parse_tagged(docs, doc_col, source_col, layout))


HISTORY = "file string, length long, modified timestamp, batch_id string"
_IDENTITY = ["file", "length", "modified"]


def landing_files(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, length, modified) of every landing file (hidden ones apart), listed
    by Spark's file index without reading contents; None without a folder."""
    from loanlake.plans.tables import exists
    if not exists(spark, path):
        return None
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")).coalesce(64)


def unloaded(found: DataFrame, history: DataFrame) -> DataFrame:
    """Files that the history doesn't hold as they are now."""
    return found.join(history.select(*_IDENTITY).distinct(), _IDENTITY, "left_anti")


def new_files(spark: SparkSession, path: str, loaded_path: str, limit: int = 10_000) -> list[tuple]:
    """The oldest ``limit`` landing files that the load history at ``loaded_path``
    does not hold as they are now (path, length and modification time): a
    file rewritten under its name is new. Only these reach the driver."""
    from loanlake.plans.tables import exists
    found = landing_files(spark, path)
    if found is None:
        return []
    if exists(spark, loaded_path):
        found = unloaded(found, spark.read.schema(HISTORY).parquet(loaded_path))
    return [tuple(r) for r in found.orderBy("modified", "file").limit(limit).collect()]


def mark_loaded(spark: SparkSession, files: list[tuple], loaded_path: str, batch_id: str) -> None:
    """Add files, as they were listed, to the load history. One that was rewritten
    while it was read has another identity by now and is new to the next run."""
    rows = [(*f, batch_id) for f in files]
    spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").parquet(loaded_path)


def _literal(path: str) -> str:
    """A path whose characters no glob takes for its own."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def landing_documents(spark: SparkSession, path: str | list[str], layout: str = "lines") -> DataFrame:
    """(doc, source) rows of a landing folder or of given files (gzip and
    other codecs are detected by suffix)."""
    path = path if isinstance(path, str) else [_literal(p) for p in path]
    if layout == "array":
        docs = spark.read.text(path, wholetext=True)
    else:
        docs = spark.read.text(path).filter(F.trim("value") != "")
    return docs.select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("source"))


def read_landing(spark: SparkSession, path: str, layout: str = "lines") -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of a landing folder."""
    return parse_documents(landing_documents(spark, path, layout), layout=layout)


def apply_defaults(events: DataFrame, loaded_at: dt.datetime, batch_id: str) -> DataFrame:
    """Raw-table defaults and audit columns (A8, B3, K12). Like a column
    DEFAULT, days_past_due 0 / is_valid TRUE fill only columns the batch does
    not carry at all; an explicit NULL stays NULL (staging handles it)."""
    out, names = events, {f.name for f in S.RAW_SCHEMA.fields}
    more = [c for c in events.columns if c not in names]      # extra fields follow
    for c, v in S.COLUMN_DEFAULTS.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v))
    return (out.withColumn("loaded_at", ts_ntz_lit(loaded_at))
            .withColumn("batch_id", F.lit(batch_id))
            .select(*[f.name for f in S.RAW_SCHEMA.fields], *more))


# ---------------------------------------------------------------------------
# Sinks (A2, A3, A7)
# ---------------------------------------------------------------------------

def write_landing(df: DataFrame, path: str, ds_col: str = "ds", as_of: dt.date | None = None,
                  columns: list[str] | None = None) -> None:
    """Append events as JSON Lines partitioned by landing date (A3). Events without
    a timestamp are filed under ``as_of`` (today if not given; pass it where a write
    may be repeated)."""
    undated = F.lit(as_of) if as_of else F.current_date()
    (df.withColumn(ds_col, F.coalesce(F.col("event_timestamp").cast("date"), undated))
     .select(to_event_json(df, columns).alias("value"), ds_col)
     .write.mode("append").partitionBy(ds_col).text(path))


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Dead-letter sink: append rejected records as JSON lines (A2)."""
    rejects.write.mode("append").json(path)


def write_scratch(df: DataFrame, path: str) -> None:
    """Full overwrite of a scratch table."""
    df.write.mode("overwrite").parquet(path)
