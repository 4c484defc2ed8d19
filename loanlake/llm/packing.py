"""Harmonic packing of token sequences.

A document's ids (and a closing id) are cut into full sequences of ``capacity``
ids and a rest. Class k takes lengths up to capacity/k that are too long for the
next class, and a sequence of class k holds exactly k pieces. A rest of which k
would leave more than ``slack`` of a sequence empty is cut: a piece of the exact
share of the next class goes first, and the remainder is classed again. Classes
never mix, so any worker can cut, class and lay out its pieces alone once it knows
how many of each class come before.

Only the last sequence of a class can be short. The pieces of these, fewer than k a
class and so bounded by ``capacity`` alone, are packed together, longest first.

Pieces stand in the order of their ids, or with ``shuffled`` in that of a hash, where
copies of a document are told apart and don't lie side by side.

A null text is an empty one: its only id is the closing id. Rows sharing an id,
repeated rows and null ids are packed each for itself. Texts of any length are
cut freely; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered, slices, span_hashes, stable, utf8

CAPACITY, SLACK, END_ID = 1024, 0.025, 0
#: Distinct text pieces that a task remembers the ids of.
REMEMBERED = 1_000_000
#: Text pieces whose tokens are held as objects, and bytes of text that are cut, at once.
ENCODED_AT_ONCE, CUT_AT_ONCE = 1 << 12, 1 << 20
#: 1 for the bytes of ASCII letters, 2 for those of ASCII marks.
_KINDS = np.array([1 if chr(b).isalpha() else 2 if chr(b).isprintable() and not chr(b).isalnum() and b != 32 else 0
                   for b in range(128)] + [0] * 128, np.uint8)


def _lengths(n: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` ids."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack * capacity or rest == 1:
            out.append((rest, k))
            break
        k = capacity // (capacity // (k + 1))  # the next smaller share, as often as it fits
        out.append((capacity // k, k))
        rest -= capacity // k
    return out


def tail_bins(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, longest first into the first bin with room."""
    room: list[int] = []
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, free in enumerate(room) if free >= lengths[i]), len(room))
        if at == len(room):
            room.append(capacity)
        out[i] = (at, capacity - room[at])
        room[at] -= lengths[i]
    return out


def white(part: np.ndarray) -> np.ndarray:
    """Which bytes belong to a white-space character."""
    p = np.concatenate([part, np.zeros(2, np.uint8)])
    a, b, c = p[:-2], p[1:-1], p[2:]
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
    out = table[part]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = ((a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
                            | ((b == 0x81) & (c == 0x9F)))
             | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80))
    for mark, width in ((two, 2), (three, 3)):
        for at in range(width if mark.any() else 0):
            out[at:] |= mark[:len(out) - at]
    return out


class Encoder:
    """ids of whole texts, added tokens in a text included. A text is cut before each lone
    space between two other characters and between an ASCII letter and a mark behind it,
    where the tokenizer starts anew in any case, but never inside an added token; the ids
    of distinct cuttings are remembered. An added token that holds a space or takes in
    spaces beside it would reach over a cut: then texts stay whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.cuts = not any(t.lstrip or t.rstrip or " " in t.content for t in added)
        self.added = [t.content.encode() for t in added]
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        lens, flat = [], []
        for at in range(0, len(texts), ENCODED_AT_ONCE):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts[at:at + ENCODED_AT_ONCE], add_special_tokens=False)]
            lens.append(np.fromiter(map(len, got), np.int64, len(got)))
            flat.append(np.fromiter(chain.from_iterable(got), np.uint32, int(lens[-1].sum())))
        slots = len(self.starts) - 1 + np.arange(len(texts))
        self.ids = np.concatenate([self.ids, *flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(lens))])
        at = np.searchsorted(self.hashes, hashes)  # both are in order
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, slots)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        return self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and per-text counts."""
        part, offsets = buf[offsets[0]:offsets[-1]], offsets - offsets[0]
        if not len(part):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        space = white(part)
        cut = np.zeros(len(part), bool)
        if self.cuts:
            kind = _KINDS[part]
            cut[1:] = (kind[:-1] == 1) & (kind[1:] == 2)
            cut[1:-1] |= (part[1:-1] == 32) & ~space[:-2] & ~space[2:]
            blob = part.tobytes()
            for token in self.added:
                at = blob.find(token)
                while at >= 0:
                    cut[at + 1:at + len(token)] = False
                    at = blob.find(token, at + len(token))
        cut[offsets[:-1][offsets[:-1] < len(part)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(part))
        hashes = span_hashes(part, starts, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self._forget()
        new = ~self._known(distinct)
        if new.any():
            blob, at = part.tobytes(), first[new]
            self._learn(distinct[new], [blob[s:e].decode("utf-8", "replace")
                                        for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slot = self.slots[np.searchsorted(self.hashes, distinct)][which]
        lens = np.diff(self.starts)[slot]
        upto = np.cumsum(lens)
        where = np.arange(int(upto[-1])) + np.repeat(self.starts[slot] - (upto - lens), lens)
        owner = np.searchsorted(offsets[1:], starts, side="right")
        return self.ids[where], np.bincount(owner, weights=lens, minlength=len(offsets) - 1).astype(np.int64)


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, slack: float = SLACK,
                  id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, class, and the ids if asked for."""
    fields = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()),
              ("doc_tokens", T.LongType()), ("class", T.IntegerType())]
    if with_ids:
        fields.append(("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType),
                           *[T.StructField(n, t) for n, t in fields]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            buf, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets, CUT_AT_ONCE):
                flat, counts = encoder.encode(buf, offsets[lo:hi + 1])
                at, rows, spans, ids = 0, [], [], []
                for row, n in enumerate(counts.tolist(), lo):
                    whole = np.append(flat[at:at + n], END_ID).astype("<u4")
                    at, start = at + n, 0
                    for length, k in _lengths(n + 1, capacity, slack):
                        piece = whole[start:start + length]
                        rows.append(row)
                        spans.append((start, length, zlib.crc32(piece.tobytes()), n + 1, k))
                        if with_ids:
                            ids.append(piece.astype(np.int32))
                        start += length
                cols = [batch.column(0).take(pa.array(rows, pa.int64()))]
                cols += [pa.array([s[i] for s in spans], pa.int32() if i == 4 else pa.int64()) for i in range(5)]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, slack: float = SLACK,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, shuffled: bool = False) -> DataFrame:
    """Each piece with its sequence and its offset there."""
    pieces = cut_documents(docs, tokenizer_path, capacity, slack, id_col, text_col, with_ids)
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    order = ["doc_id", "start", "ids_crc32"]
    if shuffled:
        told = numbered(pieces, order, ["doc_tokens"], index="copy")
        pieces = told.withColumn("mixed", F.xxhash64(F.lit(29), *order, "copy"))
        order = ["mixed", *order]
    placed = stable(numbered(pieces, ["class"], order))
    counts = F.broadcast(placed.groupBy("class").agg(F.max("idx").alias("last")))  # one row per class
    seat = placed.join(counts, "class").withColumn("seat", F.floor(F.col("idx") / F.col("class")))
    short = (F.col("last") + 1) % F.col("class") != 0
    seat = seat.withColumn("tail", short & (F.col("seat") == F.floor(F.col("last") / F.col("class"))))
    before = Window.partitionBy("class", "seat").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    full = seat.where(~F.col("tail")).select(*kept, (F.col("seat") * (capacity + 1) + F.col("class")).cast("long").alias("sequence_id"),
                                             F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))

    def lay(table: pa.Table) -> pa.Table:
        table = table.sort_by([("class", "ascending"), ("idx", "ascending")])
        bins = tail_bins(table.column("length").to_pylist(), capacity)
        return table.select(kept).append_column("sequence_id", pa.array([b * (capacity + 1) for b, _ in bins], pa.int64())).append_column(
            "offset", pa.array([o for _, o in bins], pa.int64()))

    # fewer than k pieces of class k
    tails = seat.where("tail").select(*kept, "class", "idx").groupBy(F.lit(0).alias("all")).applyInArrow(lay, full.schema)
    return full.unionByName(tails)
