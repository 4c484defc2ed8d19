"""Alignment of two tokenizers' ids over the bytes of each text, counted corpus-wide.

Documents are shuffled by full text; each distinct text is tokenised by a byte-level
BPE (A, over a space and the text) and a piece model (B, which adds that space itself)
and aligned once. Where tokens of both end at one byte, they are cut into groups; a
link is a pair of tokens whose byte ranges overlap. A link's id pair counts with the
text's multiplicity. Counts go back to the texts, and the texts' measures to the
documents by the text's SHA-256.

Neither tokenizer joins what a lone space between two other characters parts, so the
text is cut there and the ids and links of a distinct cutting are remembered. A block
holds many texts as cuttings; a longer text is a block of its own, read in slices.
The id pairs are bounded by the two vocabularies; up to ``broadcast_pairs`` of them
(18 bytes each) are broadcast, more are joined to the blocks by buckets of pairs.
Texts with more than a thousandth of all copies (at most a thousand) meet their
documents by a broadcast, so no copied text is gathered in one task.

Null or empty texts, and texts whose token bytes are not space and text, have no
tokens: zeros and ''. Rows that share an id, repeated rows and null ids are measured
each for itself. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, span_hashes, stable, utf8, written
from .packing import white

#: Text bytes of a block and of a slice of a long text, distinct cuttings that a task remembers.
BLOCK_BYTES, SLICE_BYTES, REMEMBERED = 2 << 20, 1 << 20, 400_000
#: Id pairs that may be broadcast.
BROADCAST_PAIRS, BUCKET_PAIRS = 2_000_000, 50_000
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes
    stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Ids and bytes of both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = {i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
                        for token, i in self.a.get_vocab().items()}
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, cuttings: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of cuttings, each of which starts with a space."""
        return ([e.ids for e in self.a.encode_batch_fast(cuttings, add_special_tokens=False)],
                self.b.encode([c[1:] for c in cuttings], num_threads=1))

    def align(self, raw: bytes, a: list[int], b: list[int]) -> tuple[str, int, list[tuple[int, int]]] | None:
        """(groups as text, their number, linked id pairs); None if the ids don't give the bytes."""
        parts_a, parts_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return None
        groups, links, i, j, end_a, end_b, from_i, from_j = [], [], 0, 0, len(parts_a[0]), len(parts_b[0]), 0, 0
        while True:
            links.append((a[i], b[j]))
            ahead = end_a - end_b
            if ahead <= 0:
                i += 1
            if ahead >= 0:
                j += 1
            if not ahead:
                groups.append(f"{','.join(map(str, a[from_i:i]))}|{','.join(map(str, b[from_j:j]))}")
                if i == len(a):
                    return ";".join(groups), len(groups), links
                from_i, from_j = i, j
            if ahead <= 0:
                end_a += len(parts_a[i])
            if ahead >= 0:
                end_b += len(parts_b[j])


class Cuttings:
    """The cuttings that a task has seen: measures, group texts and linked pairs of each."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.forget()

    def forget(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.groups: list[str] = []
        self.measures = np.zeros((0, 4), np.int64)  # A ids, B ids, groups, links
        self.good = np.zeros(0, bool)
        self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        ids_a, ids_b = self.tokenizers.encode([x.decode("utf-8", "replace") for x in raw])
        links, measures, good = [], [], []
        for x, a, b in zip(raw, ids_a, ids_b, strict=True):
            got = self.tokenizers.align(x, a, b) if a and b else None
            text, n, linked = got or ("", 0, [])
            self.groups.append(text)
            links.append([p << 32 | q for p, q in linked])
            measures.append((len(a), len(b), n, len(linked)))
            good.append(got is not None)
        slots = len(self.good) + np.arange(len(raw))
        lens = np.fromiter(map(len, links), np.int64, len(links))
        self.pairs = np.concatenate([self.pairs, np.fromiter(chain.from_iterable(links), np.int64, int(lens.sum()))])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lens)])
        self.measures = np.concatenate([self.measures, np.array(measures, np.int64).reshape(-1, 4)])
        self.good = np.concatenate([self.good, np.array(good, bool)])
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every)
        self.hashes, self.slots = every[order], np.concatenate([self.slots, slots])[order]

    def slots_of(self, part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the cuttings of texts that start with a space each, and where each text's begin."""
        space = white(part)
        cut = np.zeros(len(part), bool)
        cut[1:-1] = (part[1:-1] == 32) & ~space[:-2] & ~space[2:]
        cut[offsets[:-1]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(part))
        distinct, first, which = np.unique(span_hashes(part, starts, ends), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = self.hashes[at] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
        if new.any():
            blob = part.tobytes()
            self._learn(distinct[new], [blob[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
        return self.slots[np.searchsorted(self.hashes, distinct)][which], np.searchsorted(starts, offsets)


def _before(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one space before each."""
    lens = np.diff(offsets)
    out = np.full(int(offsets[-1] - offsets[0]) + len(lens), 32, np.uint8)
    out[np.arange(int(offsets[-1] - offsets[0])) + np.repeat(np.arange(1, len(lens) + 1), lens)] = buf[offsets[0]:offsets[-1]]
    return out, np.concatenate([[0], np.cumsum(lens + 1)])


def _pieces(buf: np.ndarray, size: int, look: int = 1 << 16) -> Iterator[np.ndarray]:
    """A long text in slices that end before a lone space."""
    lo = 0
    while lo < len(buf):
        hi, at = len(buf), lo + size
        while at < len(buf):
            a, b = max(0, at - 8), min(len(buf), at + look)
            space = white(buf[a:b])
            alone = (buf[a + 1:b - 1] == 32) & ~space[:-2] & ~space[2:]
            # what white() can't see at the window's ends waits for the next window
            alone[:8] = False
            found = np.flatnonzero(alone[:-8])
            if len(found):
                hi = a + 1 + int(found[0])
                break
            at = b - 16 if b < len(buf) else b
        yield buf[lo:hi]
        lo = hi


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _unpacked(value: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(value), kind)


def _summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the exact sums of their amounts."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[edge], np.add.reduceat(amounts, edge) if len(edge) else amounts


def _block(known: Cuttings, buf: np.ndarray, offsets: np.ndarray, copies: np.ndarray, slice_bytes: int):
    """(the block's row without its digests, its id pairs, their counts)."""
    text, at = _before(buf, offsets)
    if len(offsets) == 2 and len(text) > slice_bytes:
        slots = np.concatenate([known.slots_of(p, np.array([0, len(p)]))[0] for p in _pieces(text, slice_bytes)])
        begins = np.array([0, len(slots)])
    else:
        slots, begins = known.slots_of(text, at)
    good = np.logical_and.reduceat(known.good[slots], begins[:-1])
    measures = np.add.reduceat(known.measures[slots], begins[:-1], axis=0) * good[:, None]
    shas = []
    for lo, hi, fine in zip(begins[:-1].tolist(), begins[1:].tolist(), good.tolist(), strict=True):
        shas.append(hashlib.sha256(";".join([known.groups[s] for s in slots[lo:hi].tolist()]).encode()).hexdigest() if fine else "")
    lens = np.diff(begins)
    keep = np.repeat(good, lens)
    slots, weight = slots[keep], np.repeat(copies, lens)[keep]
    used, place = np.unique(slots, return_inverse=True)
    times = np.zeros(len(used), np.int64)
    np.add.at(times, place, weight)
    n = np.diff(known.starts)[used]
    upto = np.cumsum(n)
    pairs = known.pairs[np.arange(int(upto[-1]) if len(n) else 0) + np.repeat(known.starts[used] - (upto - n), n)]
    row = (_packed(measures, "<i8"), shas, _packed(lens * good, "<i8"), _packed(place, "<u4"), _packed(n, "<i4"), _packed(pairs, "<i8"))
    return row, *_summed(pairs, np.repeat(times, n))


_BLOCK = "digests binary, measures binary, shas array<string>, lens binary, places binary, n_pairs binary, pairs binary"


def aligned_blocks(distinct: DataFrame, path_a: str, path_b: str, block_bytes: int, slice_bytes: int, remembered: int) -> DataFrame:
    """Block rows, and per task one row (pair, n) for each id pair of its texts."""
    names = [f.split()[0] for f in _BLOCK.split(", ")] + ["pair", "n"]
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.string()), *[pa.binary()] * 4, pa.int64(), pa.int64()]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            known = known or Cuttings(Tokenizers(path_a, path_b))
            buf, offsets = utf8(batch.column(0))
            copies = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in slices(offsets, block_bytes):
                if len(known.groups) > remembered:
                    known.forget()
                row, more, n = _block(known, buf, offsets[lo:hi + 1], copies[lo:hi], slice_bytes)
                pairs, counts = _summed(np.concatenate([pairs, more]), np.concatenate([counts, n]))
                digests = b"".join(batch.column(2).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], k) for x, k in zip((digests, *row, None, None), kinds, strict=True)], names=names)
        for lo in range(0, len(pairs), 50_000):
            p, n = pairs[lo:lo + 50_000], counts[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(p), k) for k in kinds[:-2]] + [pa.array(p), pa.array(n)], names=names)

    return distinct.mapInArrow(align, _BLOCK + ", pair long, n long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Corpus-wide (pair, n, best): best if no other A id is linked with this B id more often.
    A B id's partners are bounded by A's vocabulary."""
    counts = blocks.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.expr("pair & 4294967295L")))
    return counts.withColumn("best", F.col("n") == most)


def _measured(batch: pa.RecordBatch, i: int, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """The texts of one block, given sorted pairs with their counts."""
    measures = _unpacked(batch.column("measures")[i].as_py(), "<i8").reshape(-1, 4)
    lens, places = _unpacked(batch.column("lens")[i].as_py(), "<i8"), _unpacked(batch.column("places")[i].as_py(), "<u4")
    n, mine = _unpacked(batch.column("n_pairs")[i].as_py(), "<i4"), _unpacked(batch.column("pairs")[i].as_py(), "<i8")
    at = np.searchsorted(pairs, mine)
    ends = np.cumsum(n)
    text_ends = np.cumsum(lens)
    sums = []
    for values in (best[at].astype(np.int64), counts[at]):
        upto = np.concatenate([[0], np.cumsum(values)])
        cutting = upto[ends] - upto[ends - n]
        upto = np.concatenate([[0], np.cumsum(cutting[places])])
        sums.append(upto[text_ends] - upto[text_ends - lens])
    digests = batch.column("digests")[i].as_py()
    return pa.RecordBatch.from_arrays(
        [pa.array([digests[k:k + 32] for k in range(0, len(digests), 32)], pa.binary()),
         *[pa.array(measures[:, k]) for k in range(4)], *[pa.array(s) for s in sums],
         pa.array(batch.column("shas")[i].as_py(), pa.string())], names=["digest", *MEASURES])


_MEASURED = "digest binary, " + ", ".join(f"{m} long" for m in MEASURES[:-1]) + ", groups_sha256 string"


def _measure_broadcast(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.orderBy("pair").toArrow()
    pairs, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _measured(batch, i, pairs, n, best)

    return blocks.mapInArrow(measure, _MEASURED)


def _measure_joined(blocks: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Blocks ask for their pairs by bucket; a bucket's answer is as long as the question."""
    blocks = stable(blocks.withColumn("block", F.monotonically_increasing_id()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = np.unique(_unpacked(batch.column("pairs")[i].as_py(), "<i8"))
                bucket = pairs % buckets
                some = np.unique(bucket)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[i].as_py()] * len(some), pa.int64()), pa.array(some),
                    pa.array([pairs[bucket == b].tobytes() for b in some], pa.binary())], names=["block", "bucket", "asked"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for asked, known in zip(batch.column("asked"), batch.column("known"), strict=True):
                asked, known = np.frombuffer(asked.as_py(), "<i8"), known.values
                pair, n, best = (known.field(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
                at = np.searchsorted(pair, asked)
                out.append((n[at].astype("<i8").tobytes(), best[at].astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("asked"), pa.array([o[0] for o in out], pa.binary()),
                                              pa.array([o[1] for o in out], pa.binary())], names=["block", "asked", "ns", "bests"])

    asked = blocks.select("block", "pairs").mapInArrow(ask, "block long, bucket long, asked binary")
    known = counts.groupBy((F.col("pair") % buckets).alias("bucket")).agg(F.sort_array(F.collect_list(F.struct("pair", "n", "best"))).alias("known"))
    told = asked.join(known, "bucket").mapInArrow(answer, "block long, asked binary, ns binary, bests binary")
    told = told.groupBy("block").agg(F.collect_list(F.struct("asked", "ns", "bests")).alias("told"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got = batch.column("told")[i].as_py() or []
                pairs, n = (np.frombuffer(b"".join(x[c] for x in got), "<i8") for c in ("asked", "ns"))
                best = np.frombuffer(b"".join(x["bests"] for x in got), np.uint8)
                order = np.argsort(pairs)
                yield _measured(batch, i, pairs[order], n[order], best[order])

    return blocks.join(told, "block", "left").drop("block").mapInArrow(measure, _MEASURED)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES, slice_bytes: int = SLICE_BYTES, remembered: int = REMEMBERED,
                     broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(doc_id and ``MEASURES`` of every document, corpus-wide id pairs a, b, n, best)."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    empty = F.col("text").isNull() | (F.col("text") == "")
    distinct = texts.where(~empty).groupBy("text").agg(F.count("*").alias("copies"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    blocks = written(aligned_blocks(distinct.select("text", "copies", digest.alias("digest")), path_a, path_b,
                                    block_bytes, slice_bytes, remembered))
    counts = stable(pair_counts(blocks))
    rows, n_pairs = blocks.where("digests is not null").drop("pair", "n"), counts.count()
    if n_pairs <= broadcast_pairs:
        measured = _measure_broadcast(rows, counts)
    else:
        measured = _measure_joined(rows, counts, max(1, n_pairs // BUCKET_PAIRS))
    measured = written(measured)
    ids = stable(texts.select("doc_id", F.when(~empty, digest).alias("digest")))
    # at most a thousand texts have more than a thousandth of the rows
    copies = ids.where("digest is not null").groupBy("digest").agg(F.count("*").alias("copies"))
    often = F.broadcast(copies.where(F.col("copies") > max(1, ids.count() // 1000)).select("digest"))
    zeros = [F.lit("") if m == "groups_sha256" else F.lit(0).cast("long") for m in MEASURES]
    out = ids.where("digest is null").select("doc_id", *[z.alias(m) for z, m in zip(zeros, MEASURES, strict=True)])
    for kind in ("semi", "anti"):
        theirs, mine = measured.join(often, "digest", kind), ids.where("digest is not null").join(often, "digest", kind)
        out = out.unionByName(mine.join(F.broadcast(theirs) if kind == "semi" else theirs, "digest").select("doc_id", *MEASURES))
    return out, counts.select(F.expr("cast(shiftright(pair, 32) as int)").alias("a"),
                              F.expr("cast(pair & 4294967295L as int)").alias("b"), "n", "best")
