"""Table helpers over plain parquet folders: read-or-empty, and versioned
folders with a pointer file for atomic replacement (H2, H5, A12)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty frame of ``schema`` on first run
    (CREATE ... IF NOT EXISTS, H5)."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw table in either layout (flat, or partitioned by event_date),
    as the raw schema's columns and the extra fields its record names; empty on first run."""
    from loanlake import schema as S
    mark = read_marker(spark, path.rstrip("/") + "_schema.json")
    schema = T.StructType.fromJson(mark["schema"]) if mark else S.RAW_SCHEMA
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def _read_text(spark, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def _write_text(spark, path: str, text: str) -> None:
    """Write a small file beside its place, then rename it over the old one in
    one step: a reader sees the old text or the new one, never none."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(path + f".tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.valueOf("OVERWRITE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), how)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_marker(spark: SparkSession, path: str) -> dict | None:
    """A small JSON marker file (e.g. a refresh watermark), or None."""
    txt = _read_text(spark, path)
    return json.loads(txt) if txt else None


def write_marker(spark: SparkSession, path: str, value: dict) -> None:
    """Replace a marker file via temp + rename."""
    _write_text(spark, path, json.dumps(value, default=str))


class VersionedTable:
    """A table whose every rewrite goes to a new ``v=<n>`` folder; readers
    follow ``_CURRENT``. A path cannot be overwritten while it is read, and a
    failed rewrite leaves the previous version current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def pointer(self) -> dict | None:
        txt = _read_text(self.spark, f"{self.root}/_CURRENT")
        return json.loads(txt) if txt else None

    def current(self) -> str | None:
        p = self.pointer()
        return p["path"] if p else None

    def read(self, schema: T.StructType | None = None) -> DataFrame | None:
        cur = self.current()
        if cur is None:
            return None
        r = self.spark.read
        return (r.schema(schema) if schema else r).parquet(cur)

    def write(self, df: DataFrame, partition_by: list[str] | None = None,
              sort_within: list[str] | None = None, meta: dict | None = None,
              observation=None) -> str:
        cur = self.current()
        n = int(cur.rsplit("v=", 1)[1]) + 1 if cur else 0
        path = f"{self.root}/v={n}"
        out = df.sortWithinPartitions(*sort_within) if sort_within else df
        if observation is not None:
            out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
        w = out.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _write_text(self.spark, f"{self.root}/_CURRENT", json.dumps({"path": path, **(meta or {})}, default=str))
        if n > 1:                       # the version before stays for readers that still follow it
            remove(self.spark, f"{self.root}/v={n - 2}")
        return path


def overwrite_partitions(spark: SparkSession, df: DataFrame, path: str, partition_col: str,
                         sort_cols: list[str], staging_dir: str, record: dict | None = None) -> None:
    """Replace only the ``partition_col`` partitions present in ``df``; with
    ``record`` (a schema record) the table has that schema from the swap on.

    ``df`` usually reads the same table, and a path cannot be overwritten
    while it is read, so the new partitions are first written whole to a
    staging folder (under the shared checkpoint dir). A marker beside the
    table names that folder until the swap is over: after a crash at any
    point ``finish_swap`` brings the table to the staged state."""
    clustered(df, partition_col, sort_cols).write.mode("overwrite").partitionBy(partition_col).parquet(staging_dir)
    write_marker(spark, swap_marker(path), {"staging": staging_dir, "partition": partition_col, "record": record})
    finish_swap(spark, path)


def swap_marker(path: str) -> str:
    return path.rstrip("/") + "_swap.json"


def finish_swap(spark: SparkSession, path: str) -> bool:
    """Swap in staged partitions that a marker names, if there is one; doing
    it again changes nothing. Run before anything reads the table."""
    mark = read_marker(spark, swap_marker(path))
    if mark is None:
        return False
    if mark.get("record"):
        # Old files read under the new schema, new ones not under the old: the record goes first.
        write_marker(spark, path.rstrip("/") + "_schema.json", mark["record"])
        schema = T.StructType.fromJson(mark["record"]["schema"])
    else:
        schema = spark.read.parquet(path).schema
    staged = spark.read.schema(schema).parquet(mark["staging"])
    # Staged files are already clustered: each holds one partition value,
    # so the swap is a plain copy without another shuffle.
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(mark["partition"]).parquet(path))
    remove(spark, swap_marker(path))
    remove(spark, mark["staging"])
    return True


def clustered(df: DataFrame, partition_col: str, sort_cols: list[str]) -> DataFrame:
    """Cluster rows for a write partitioned by ``partition_col`` (A12): one
    shuffle groups each partition value, the sort gives tight row-group
    min/max statistics on the sort columns. Range partitioning on (partition, sort
    columns) splits a hot partition value over several tasks instead of
    sending it whole to one. Use with partitionBy on write."""
    return df.repartitionByRange(partition_col, *sort_cols).sortWithinPartitions(partition_col, *sort_cols)
