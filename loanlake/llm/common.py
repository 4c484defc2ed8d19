"""Shared helpers: stable intermediates, global numbering, Arrow text access."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlake.session import ensure_checkpoint_dir

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The same white space for numpy byte masks.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def stable(df: DataFrame) -> DataFrame:
    """Cut lineage through the reliable checkpoint folder. What follows sees one
    fixed set of partitions, also after a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like ``stable``, as a Parquet table in the same folder. For loops: what the
    optimizer infers about a checkpoint grows from round to round, about a table it doesn't."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written once as a bucketed table in the same folder: joins on ``key`` read it
    in place, without a shuffle of its rows. The name leaves the catalog at once."""
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    table = df.sparkSession.table(name)
    df.sparkSession.sql(f"drop table {name}")  # an external table: the files stay
    return table


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str | None = None,
             index: str = "idx", before: str = "before") -> DataFrame:
    """Add the gapless position of each row in its group (``index``, from 0) and,
    with ``amount``, the sum of the amounts before it (``before``).

    No group is gathered in one task: rows are range-partitioned by group and
    order (rows alike in both are told apart by their place in the checkpoint),
    numbered within a partition, and shifted by the totals of the earlier
    partitions of their group, of which there is one row per partition.
    """
    tie = "_tie"
    fixed = stable(df).withColumn(tie, F.monotonically_increasing_id())
    ranged = stable(fixed.repartitionByRange(*group, *order, tie).withColumn("_part", F.spark_partition_id()))
    inner = Window.partitionBy("_part", *group).orderBy(*order, tie)
    value = F.col(amount) if amount else F.lit(1)
    totals = ranged.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in group],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_s0"))
    local = ranged.withColumn("_i", F.row_number().over(inner) - 1)
    if amount:
        upto = inner.rowsBetween(Window.unboundedPreceding, -1)
        local = local.withColumn("_s", F.coalesce(F.sum(amount).over(upto), F.lit(0)))
    cond = F.col("_part") == F.col("_p")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = local.join(shift, cond).withColumn(index, (F.col("_i") + F.col("_n0")).cast("long"))
    if amount:
        out = out.withColumn(before, (F.col("_s") + F.col("_s0")).cast("long"))
    return out.drop(tie, "_part", "_p", "_i", "_s", "_n0", "_s0", *[f"_g_{g}" for g in group])


def shielded(docs: DataFrame, own: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)``, while all columns but ``own`` travel under names that no operator
    uses; what it returns gets them back, columns of its own with such a name give way."""
    others = [c for c in docs.columns if c not in own]
    neutral = {c: f"carried_{i}__" for i, c in enumerate(others)}
    out = work(docs.select(*[F.col(f"`{c}`").alias(neutral.get(c, c)) for c in docs.columns]))
    back = {n: c for c, n in neutral.items() if n in out.columns}
    taken = {c.lower() for c in back.values()}
    return out.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in out.columns if c in back or c.lower() not in taken])


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the decimal text of ``key``, modulo ``n`` (a null key counts as '')."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string array; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offsets


def slices(offsets: np.ndarray, max_bytes: int, max_rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text and ``max_rows`` rows, a longer text alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + max_rows)
        yield lo, hi
        lo = hi


_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: differences of one polynomial prefix sum."""
    n = len(buf)
    head = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_P, n), out=head[1:])
    h = (head[ends] - head[starts]) * powers(_PINV, n + 1)[starts]
    return mix64(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one byte buffer. Texts must be kept apart
    by a white-space byte."""
    table = np.ones(256, np.int8)
    table[list(SPACE_BYTES)] = 0
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = table[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def spaced(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A copy of the texts with one space after each; returns it and the texts' starts in it."""
    lens = np.diff(offsets)
    part = buf[offsets[0]:offsets[-1]]
    out = np.full(len(part) + len(lens), 32, np.uint8)
    place = np.arange(len(part)) + np.repeat(np.arange(len(lens)), lens)
    out[place] = part
    return out, np.concatenate([[0], np.cumsum(lens + 1)])


def ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All positions of the ranges [a, b), one behind the other."""
    n = b - a
    upto = np.cumsum(n)
    return np.arange(int(upto[-1]) if len(n) else 0) + np.repeat(a - (upto - n), n)
