"""Keys of the raw table in hash buckets (F3, H4): a key check that doesn't read every key.

``<root>/gen=<g>/bucket=<b>`` holds the keys whose hash falls into bucket b, sorted,
with Parquet bloom filters. A bucket holds about ``bucket_keys`` keys at every size of the
table: the number of buckets doubles with the keys, in a new generation that a pointer
(``_index.json``) names once it is whole. A batch reads the folders of its own keys'
buckets, whatever else the table holds, so a key is found again whatever timestamp it
comes back with.

Raw rows and their keys are written by two jobs. A marker (``_pending.json``) stands
while they are under way: after a crash ``recover`` adds the keys of whatever reached
the raw table, before anything is looked up. A key that is added twice is one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.plans.tables import exists, read_marker, remove, write_marker
from loanlake.session import ensure_checkpoint_dir

#: Keys of a bucket, appended batches after which buckets are written anew.
BUCKET_KEYS, MAX_APPENDS = 1 << 20, 64


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, key: str = "event_id", bucket_keys: int = BUCKET_KEYS,
                 max_appends: int = MAX_APPENDS):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.bucket_keys, self.max_appends = bucket_keys, max_appends

    # -- state ---------------------------------------------------------------
    def pointer(self) -> dict | None:
        return read_marker(self.spark, f"{self.root}/_index.json")

    def _point(self, **value) -> None:
        write_marker(self.spark, f"{self.root}/_index.json", value)

    def _folder(self, gen: int) -> str:
        return f"{self.root}/gen={gen}"

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _write(self, keys: DataFrame, gen: int, buckets: int, mode: str) -> None:
        """One file per bucket: bounded by ``bucket_keys`` or the batch."""
        placed = keys.select(self.key).where(F.col(self.key).isNotNull()).withColumn("bucket", self._bucket(buckets))
        (placed.repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode(mode)
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(2 * self.bucket_keys))
         .partitionBy("bucket").parquet(self._folder(gen)))

    def all_keys(self) -> DataFrame | None:
        p = self.pointer()
        if p is None or not exists(self.spark, self._folder(p["gen"])):
            return None
        return self.spark.read.schema(f"{self.key} string").parquet(self._folder(p["gen"])).select(self.key)

    # -- building ------------------------------------------------------------
    def build(self, keys: DataFrame) -> None:
        """Write a generation from all keys: at the start, and when buckets are full or in many files."""
        p = self.pointer()
        gen = p["gen"] + 1 if p else 0
        distinct = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        n = distinct.count()
        buckets = 1
        while buckets * self.bucket_keys < n:
            buckets *= 2
        self._write(distinct, gen, buckets, "overwrite")
        self._point(gen=gen, buckets=buckets, keys=n, appends=0)
        if p and p["gen"] > 0:          # the generation before stays for readers under way
            remove(self.spark, self._folder(p["gen"] - 1))

    def add(self, keys: DataFrame, n: int) -> None:
        """Append ``n`` new keys; buckets are written anew once they are full or in many files."""
        p = self.pointer()
        if n:
            self._write(keys, p["gen"], p["buckets"], "append")
        p = {**p, "keys": p["keys"] + n, "appends": p["appends"] + (n > 0)}
        self._point(**p)
        if p["keys"] > p["buckets"] * self.bucket_keys or p["appends"] > self.max_appends:
            self.build(self.all_keys())

    # -- lookup --------------------------------------------------------------
    def touched(self, batch_keys: DataFrame) -> list[str]:
        """Folders of the buckets that these keys can be in: at most one per key, and per bucket."""
        p = self.pointer()
        if p is None or not p["keys"]:
            return []
        rows = batch_keys.where(F.col(self.key).isNotNull()).select(self._bucket(p["buckets"]).alias("b")).distinct().collect()
        paths = [f"{self._folder(p['gen'])}/bucket={r['b']}" for r in rows]
        return sorted(x for x in paths if exists(self.spark, x))

    def known(self, batch_keys: DataFrame) -> DataFrame:
        """Those of the batch's keys that the table has. The answer is fixed: it is as
        large as the batch and read before anything is written."""
        mine = batch_keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        paths = self.touched(mine)
        if not paths:
            return mine.limit(0)
        ensure_checkpoint_dir(self.spark)
        there = self.spark.read.schema(f"{self.key} string").parquet(*paths)
        return mine.join(there, self.key, "left_semi").checkpoint()

    # -- loading -------------------------------------------------------------
    def begin(self, batch_id: str) -> None:
        write_marker(self.spark, f"{self.root}/_pending.json", {"batch_id": batch_id})

    def finish(self) -> None:
        remove(self.spark, f"{self.root}/_pending.json")

    def recover(self, raw: DataFrame | None) -> None:
        """Bring the index up to the raw table: built from it if there is none, with the
        keys of a load that didn't finish if there was one."""
        if raw is None:
            if self.pointer() is None:
                self._point(gen=0, buckets=1, keys=0, appends=0)
            return
        if self.pointer() is None:
            self.build(raw)
            return self.finish()
        pending = read_marker(self.spark, f"{self.root}/_pending.json")
        if pending is not None:
            left = raw.where(F.col("batch_id") == pending["batch_id"]).select(self.key).distinct()
            fresh = left.join(self.known(left), self.key, "left_anti").checkpoint()
            self.add(fresh, fresh.count())
            self.finish()
