"""Keyed tables kept in hash buckets (H1, Q9).

Rows lie in buckets by the hash of their key. A manifest (``_buckets.json``) names the
folder of each bucket, so a write replaces the buckets of the keys it touched and no
other, and becomes visible in one step when the manifest is renamed into place. A write
that dies before leaves the old buckets as they were. Folders that a write replaced stay
until the next one, for readers that still follow the manifest before.

A bucket holds about ``bucket_rows`` rows at every size of the table: once there are
twice as many, everything is dealt again over twice the buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.plans.tables import exists, read_marker, remove, write_marker
from loanlake.session import ensure_checkpoint_dir

BUCKET_ROWS = 100_000


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, key: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.key, self.bucket_rows = spark, root.rstrip("/"), key, bucket_rows

    def pointer(self) -> dict | None:
        return read_marker(self.spark, f"{self.root}/_buckets.json")

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of these keys: at most as many as there are buckets."""
        p = self.pointer()
        return sorted(r[0] for r in keys.select(self._bucket(p["buckets"])).distinct().collect()) if p else []

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or only the rows of some buckets."""
        p = self.pointer()
        if p is None:
            return None
        schema = T.StructType.fromJson(p["schema"])
        which = p["folders"] if buckets is None else {str(b): p["folders"][str(b)] for b in buckets if str(b) in p["folders"]}
        paths = sorted(f"{self.root}/{v}/_bucket={b}" for b, v in which.items())
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _put(self, df: DataFrame, n: int) -> tuple[str, list[str], int]:
        """Write rows into a new folder; (its name, the buckets it has, its rows)."""
        name, seen = f"w={uuid.uuid4().hex}", Observation("rows")
        placed = df.observe(seen, F.count(F.lit(1)).alias("n")).withColumn("_bucket", self._bucket(n))
        # a bucket is bounded, so it may be one file
        placed.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{name}")
        rows = seen.get["n"]
        there = []
        if rows:
            there = [str(r[0]) for r in self.spark.read.parquet(f"{self.root}/{name}").select("_bucket").distinct().collect()]
        return name, there, rows

    def write(self, df: DataFrame, meta: dict | None = None) -> None:
        """Replace the whole table."""
        p, schema = self.pointer(), df.schema
        ensure_checkpoint_dir(self.spark)
        df = df.checkpoint()                                # counted, then dealt
        rows = df.count()
        n = 1
        while n * self.bucket_rows < rows:
            n *= 2
        name, there, rows = self._put(df, n)
        self._publish(p, {"buckets": n, "rows": rows, "folders": {b: name for b in there}}, schema, meta,
                      [f"{v}/_bucket={b}" for b, v in p["folders"].items()] if p else [])

    def replace(self, df: DataFrame, buckets: list[int], meta: dict | None = None) -> None:
        """Replace the rows of some buckets by ``df``, which holds only keys of these."""
        p = self.pointer()
        old = {str(b): p["folders"][str(b)] for b in buckets if str(b) in p["folders"]}
        before = self.read(buckets).count()                 # from the files' footers
        schema = df.schema
        name, there, rows = self._put(df, p["buckets"]) if buckets else ("", [], 0)
        folders = {b: v for b, v in p["folders"].items() if b not in old} | {b: name for b in there}
        now = {"buckets": p["buckets"], "rows": p["rows"] - before + rows, "folders": folders}
        self._publish(p, now, schema if buckets else None, meta, [f"{v}/_bucket={b}" for b, v in old.items()])
        if now["rows"] > 2 * now["buckets"] * self.bucket_rows:
            self.write(self.read(), meta)

    def _publish(self, before: dict | None, now: dict, schema, meta: dict | None, replaced: list[str]) -> None:
        value = schema.jsonValue() if schema is not None else before["schema"]
        for f in value["fields"]:
            f["nullable"] = True
        write_marker(self.spark, f"{self.root}/_buckets.json", {**now, "schema": value, "replaced": replaced, **(meta or {})})
        for path in (before or {}).get("replaced", []):
            if exists(self.spark, f"{self.root}/{path}"):
                remove(self.spark, f"{self.root}/{path}")
