"""Blocks of texts, and which of their 64-bit hashes the whole table has twice.

A block is one row that holds the bytes of many documents (a longer text has a
block of its own). Blocks send each distinct hash once, with its count, as a
32-bit print in a hash-range bucket; the number of buckets grows with the input,
so a chance match of two hashes stays rare and only costs time. A hash that is
everywhere arrives once per block, never once per document. Block and bucket
sizes are parameters: larger ones mean fewer messages.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stable, utf8

LOW = np.uint64(0xFFFFFFFF)
#: The frequency class of hot hashes.
HOT = 255
BLOCK_BYTES = 2 << 20


def text_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, fixed: bool = True) -> DataFrame:
    """Blocks with the documents' ids, text lengths in bytes (-1: no text) and deflated texts;
    not ``fixed`` is for callers that write them as a table at once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets, block_bytes):
                ids = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                    pa.array([ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
                    pa.array([np.diff(offsets[lo:hi + 1]).astype("<i8").tobytes()], pa.binary()),
                    pa.array([zlib.compress(buf[offsets[lo]:offsets[hi]].tobytes(), 6)], pa.binary()),
                    pa.array([int(offsets[hi] - offsets[lo])])],
                    names=["ids", "nulls", "lens", "texts", "size"])

    schema = "ids binary, nulls binary, lens binary, texts binary, size long"
    cast = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    blocks = cast.mapInArrow(cut, schema).withColumn("block", F.monotonically_increasing_id())
    return stable(blocks) if fixed else blocks


def block_ids(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(batch.column("ids")[i].as_py(), "<i8"),
            np.frombuffer(batch.column("nulls")[i].as_py(), np.uint8).astype(bool))


def block_texts(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    lens = np.frombuffer(batch.column("lens")[i].as_py(), "<i8")
    text = zlib.decompress(batch.column("texts")[i].as_py())
    return np.frombuffer(text, np.uint8) if text else np.zeros(0, np.uint8), np.concatenate([[0], np.cumsum(lens)])


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _count_bytes(n: np.ndarray) -> np.ndarray:
    """Counts of a block as bytes: exact up to 128, rising with the logarithm above."""
    return np.where(n <= 128, n, np.minimum(255, 128 + np.ceil(8 * np.log2(np.maximum(n, 128) / 128)))).astype(np.uint8)


def _counts(coded: np.ndarray) -> np.ndarray:
    return np.where(coded <= 128, coded, 128 * 2.0 ** ((coded.astype(np.float64) - 128) / 8)).astype(np.int64)


def shared_prints(blocks: DataFrame, hashes_of: Callable[..., np.ndarray], buckets: int, using: str | None = None,
                  hot: int | None = None) -> DataFrame:
    """(block, heard, n, n_hot): for each block its prints that the table has twice or
    more, by bucket, with a frequency class (1 to 255, rising with the count), and how
    many hashes of the block these are, hot ones apart. With ``hot`` the class is 1, or
    ``HOT`` for more than so many hashes beyond two a block. ``hashes_of`` gets a block's
    bytes, offsets and, if given, its value of the column ``using``."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                more = [batch.column(using)[i].as_py()] if using else []
                every = np.sort(hashes_of(*block_texts(batch, i), *more))
                if not len(every):
                    continue
                edge = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
                distinct, n = every[edge], _count_bytes(np.diff(np.append(edge, len(every))))
                cuts = np.searchsorted(bucket_of(distinct, buckets), np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts))
                low = (distinct & LOW).astype("<u4")
                spans = [(int(cuts[b]), int(cuts[b + 1])) for b in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[i].as_py()] * len(some), pa.int64()),
                    pa.array(some.astype(np.int64)),
                    pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([zlib.compress(n[a:b].tobytes(), 1) for a, b in spans], pa.binary())],
                    names=["block", "bucket", "prints", "counts"])

    def count(table: pa.Table) -> pa.Table:
        prints = [np.frombuffer(x.as_py(), "<u4") for x in table.column("prints")]
        counts = [_counts(np.frombuffer(zlib.decompress(x.as_py()), np.uint8)) for x in table.column("counts")]
        key = (np.concatenate(prints).astype(np.uint64) << np.uint64(32)) | np.arange(sum(map(len, prints)), dtype=np.uint64)
        key = np.sort(key)
        at = (key & LOW).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] ^ key[:-1]) >> np.uint64(32) != 0]))
        total = np.add.reduceat(np.concatenate(counts)[at], edge)
        times = np.diff(np.append(edge, len(key)))
        if hot is None:
            rank = np.minimum(255, np.ceil(8 * np.log2(np.maximum(total, 1))))
        else:
            rank = np.where(total - 2 * times > hot, HOT, 1)
        rank = np.where(total > 1, rank, 0).astype(np.uint8)
        freq = np.empty(len(key), np.uint8)
        freq[at] = np.repeat(rank, times)
        out, lo = [], 0
        for p, c in zip(prints, counts, strict=True):
            f = freq[lo:lo + len(p)]
            out.append((p[f > 0].tobytes(), f[f > 0].tobytes(), int(c[(f > 0) & (f < HOT)].sum()), int(c[f == HOT].sum())))
            lo += len(p)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "prints": pa.array([x[0] for x in out], pa.binary()),
                         "freqs": pa.array([x[1] for x in out], pa.binary()),
                         "n": pa.array([x[2] for x in out], pa.int64()), "n_hot": pa.array([x[3] for x in out], pa.int64())})

    sent = blocks.select("block", "lens", "texts", *([using] if using else [])).mapInArrow(send, "block long, bucket long, prints binary, counts binary")
    back = sent.groupBy("bucket").applyInArrow(
        count, "block long, bucket long, prints binary, freqs binary, n long, n_hot long")
    return back.where("octet_length(prints) > 0").groupBy("block").agg(
        F.collect_list(F.struct("bucket", "prints", "freqs")).alias("heard"), F.sum("n").alias("n"), F.sum("n_hot").alias("n_hot"))


def frequency(hashes: np.ndarray, heard: list[dict] | None, buckets: int) -> np.ndarray:
    """Frequency class of each hash, 0 for one that the table has once."""
    if not heard or not len(hashes):
        return np.zeros(len(hashes), np.uint8)
    key = np.concatenate([np.frombuffer(x["prints"], "<u4").astype(np.uint64) | np.uint64(x["bucket"] << 32) for x in heard])
    freq = np.concatenate([np.frombuffer(x["freqs"], np.uint8) for x in heard])
    order = np.argsort(key)
    key, freq = key[order], freq[order]
    asked = (bucket_of(hashes, buckets) << np.uint64(32)) | (hashes & LOW)
    at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
    return np.where(key[at] == asked, freq[at], 0).astype(np.uint8)
