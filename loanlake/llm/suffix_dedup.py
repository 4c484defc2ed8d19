"""Exact removal of repeated substrings by a distributed difference-cover suffix sort.

A byte goes if a ``need``-byte string that covers it also starts elsewhere, in the
same or another document. Suffixes that can share such a string are brought
together first: each ``need``-byte window names its anchor, the least hash among
its ``GRAM``-byte strings (the first of equals), a function of the window alone.
Anchors that the table has once can't repeat; windows of the others travel, as one
short string per run of windows with a common anchor, to the bucket of that anchor's
hash. Copies of a string are folded per block, so a passage that is everywhere
arrives once per block.

An anchor is hot if its distinct strings, beyond two of each block, would be more than
a bucket: text of ``GRAM`` bytes or more that many documents surround by words of their own.
Its windows are named anew, by the least hash among their longer strings, which take
in more of what surrounds the anchor: those that the table has once can't repeat, hot
ones are named by still longer strings, up to the whole window, whose copies are one
string per block. Each name is a function of the window and of counts over the table,
so equal windows go the same way.

A bucket sorts all suffixes of its strings by the difference-cover algorithm: name
the triples at positions 1 and 2 modulo 3 in sorted order, recurse on the names
(until a name covers ``need`` bytes), sort the remaining suffixes by first byte and
next rank, merge. Windows that are neighbours in this order and agree in all
``need`` bytes are repeated; the bytes themselves are compared. The windows' marks
return to their blocks, where covered bytes are cut.

Strings are judged on the input. A null text is an empty one; texts shorter than
``need`` bytes keep everything. Repeated rows are copies like any others; null ids
come back as they are. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, powers, ranges, span_hashes, stable
from .exchange import BLOCK_BYTES, HOT, block_ids, block_texts, bucket_of, frequency, shared_prints, text_blocks

NEED, GRAM = 200, 64
#: Anchors of a counting bucket, string bytes of a sorting bucket.
BUCKET_ANCHORS, BUCKET_BYTES = 200_000, 600_000
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _gram_hashes(buf: np.ndarray, width: int) -> np.ndarray:
    n = len(buf)
    head = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_P, n), out=head[1:])
    return mix64((head[width:] - head[:-width]) * powers(_PINV, n + 1)[:n - width + 1])


def anchor_runs(buf: np.ndarray, offsets: np.ndarray, need: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor hash) of each run of windows with a common anchor."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    if len(buf) < need:
        return none
    hashes, w = _gram_hashes(buf, gram), need - gram + 1
    n = len(hashes)
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - w + 1], ahead[w - 1:n])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = ranges(offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - need + 1))
    if not len(starts):
        return none
    anchor = at[starts]
    edge = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)]))
    return starts[edge], starts[np.append(edge[1:], len(starts)) - 1], mix64(hashes[anchor[edge]] ^ np.uint64(0xA5A5A5A5))


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def _order(key: np.ndarray, bits: int) -> np.ndarray:
    """A sorting permutation of non-negative keys of so many bits."""
    n = len(key)
    if bits + _bits(n) <= 64:
        shift = np.uint64(_bits(n))
        packed = np.sort((key.astype(np.uint64) << shift) | np.arange(n, dtype=np.uint64))
        return (packed & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    return np.argsort(key, kind="stable")


def _joined(parts: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, int]:
    """One key that orders like the columns; columns are (values, bits)."""
    key, bits = parts[0][0].astype(np.uint64), parts[0][1]
    for values, more in parts[1:]:
        if bits + more > 64:  # rank what there is
            distinct, key = np.unique(key, return_inverse=True)
            key, bits = key.astype(np.uint64), _bits(len(distinct))
        key, bits = (key << np.uint64(more)) | values.astype(np.uint64), bits + more
    return key, bits


def _dense(key: np.ndarray, bits: int) -> np.ndarray:
    """Ranks from 1, equal for equal keys."""
    order = _order(key, bits)
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]])) if len(key) else 0
    return rank


def suffix_ranks(s: np.ndarray, depth: int, need: int) -> np.ndarray:
    """Rank of every suffix of ``s`` (values from 1, each standing for ``depth`` bytes),
    right as far as suffixes differ within ``need`` bytes."""
    n = len(s)
    t = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.int64)
    width = _bits(int(s.max(initial=0)))
    if 3 * depth >= need or n < 3:
        return _dense(*_joined([(t[:n], width), (t[1:n + 1], width), (t[2:n + 2], width)]))
    one, two, zero = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])
    names = _dense(*_joined([(t[sample], width), (t[sample + 1], width), (t[sample + 2], width)]))
    inner = suffix_ranks(np.concatenate([names[:len(one)], [0], names[len(one):]]), 3 * depth, need)
    rank = np.zeros(n + 3, np.int64)
    rank[one], rank[two] = inner[:len(one)], inner[len(one) + 1:]
    rw = _bits(int(rank.max()))
    # the remaining suffixes by first symbol and next rank
    key, bits = _joined([(t[zero], width), (rank[zero + 1], rw)])
    zero = zero[_order(key, bits)]
    merged = sample[_order(rank[sample], rw)]
    is_one = merged % 3 == 1
    ones, twos = merged[is_one], merged[~is_one]
    # how many sampled suffixes stand before each of them
    both = np.concatenate([ones, zero])
    key, _ = _joined([(t[both], width), (rank[both + 1], rw)])
    before = np.searchsorted(key[:len(ones)], key[len(ones):])
    both = np.concatenate([twos, zero])
    key, _ = _joined([(t[both], width), (t[both + 1], width), (rank[both + 2], rw)])
    before = before + np.searchsorted(key[:len(twos)], key[len(twos):])
    slot = np.maximum.accumulate(before) + np.arange(len(zero))
    free = np.ones(n, bool)
    free[slot] = False
    out = np.empty(n, np.int64)
    out[zero] = slot + 1
    out[merged] = np.flatnonzero(free) + 1
    return out


def repeated_windows(strings: list[np.ndarray], need: int) -> list[np.ndarray]:
    """For each of these distinct byte strings, which of its ``need``-byte windows
    occur again, in it or in another."""
    counts = np.array([len(x) - need + 1 for x in strings])
    text = np.concatenate([y for x in strings for y in (x.astype(np.int64) + 1, [0])])
    base = np.concatenate([[0], np.cumsum([len(x) + 1 for x in strings])])[:-1]
    rank = suffix_ranks(text, 1, need)
    at = ranges(base, base + counts)
    order = at[_order(rank[at], _bits(len(text)))]
    raw = np.lib.stride_tricks.sliding_window_view(
        np.concatenate([text.astype(np.uint8), np.zeros(need, np.uint8)]), need)
    same = np.zeros(len(order), bool)  # equal to the one before; the separators lie outside all windows
    for lo in range(1, len(order), 20_000):
        hi = min(lo + 20_000, len(order))
        rows = raw[order[lo - 1:hi]]
        same[lo:hi] = (rows[1:] == rows[:-1]).all(axis=1)
    hit = same.copy()
    hit[:-1] |= same[1:]
    mark = np.zeros(len(text), bool)
    mark[order] = hit
    return [mark[b:b + c] for b, c in zip(base.tolist(), counts.tolist(), strict=True)]


def gram_lengths(need: int, gram: int) -> list[int]:
    """The anchor lengths in turn, up to the whole window."""
    out = [gram]
    while out[-1] < need:
        out.append(need if need - out[-1] < 32 else (out[-1] + need + 1) // 2)
    return out


def _runs_of(buf: np.ndarray, offsets: np.ndarray, windows: np.ndarray | None, need: int,
             gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``anchor_runs`` of all windows, or of the given ones (rising) without reading the rest."""
    if windows is None:
        return anchor_runs(buf, offsets, need, gram)
    edge = np.flatnonzero(np.concatenate([[True], np.diff(windows) != 1])[:len(windows)])
    lo, hi = windows[edge], windows[np.append(edge[1:], len(windows))[:len(edge)] - 1] + need
    place = ranges(lo, hi)
    first, last, anchor = anchor_runs(buf[place], np.concatenate([[0], np.cumsum(hi - lo)]), need, gram)
    return place[first], place[last], anchor


def _leveled(buf: np.ndarray, offsets: np.ndarray, heard: list, anchors: list[int], need: int,
             grams: list[int]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray | None]:
    """Runs that may repeat, by the length that names them, and the windows that wait
    for the length after those (None: all windows)."""
    out, windows = [], None
    for level, (told, size) in enumerate(zip(heard, anchors, strict=True)):
        first, last, anchor = _runs_of(buf, offsets, windows, need, grams[level])
        freq = frequency(anchor, told, size)
        over = freq == HOT
        keep = (freq > 0) & ~over
        out.append((first[keep], last[keep], mix64(anchor[keep] ^ np.uint64(level))))
        windows = ranges(first[over], last[over] + 1)
        if not len(windows):
            break
    return out, windows


def _named(buf: np.ndarray, runs: tuple[np.ndarray, np.ndarray, np.ndarray], need: int) -> np.ndarray:
    """Each run's anchor once per distinct string, but twice at least if it is there twice."""
    first, last, anchor = runs
    if not len(first):
        return anchor
    content = span_hashes(buf, first, last + need)
    order = np.lexsort((content, anchor))
    a, c = anchor[order], content[order]
    other = np.concatenate([[True], a[1:] != a[:-1]])
    keep = other | np.concatenate([[False], c[1:] != c[:-1]]) | np.concatenate([[False], other[:-1]])
    return a[keep]


def _strings(buf: np.ndarray, offsets: np.ndarray, heard: list, anchors: list[int], buckets: int, need: int,
             grams: list[int]):
    """Runs that may repeat, and the distinct strings among them by bucket:
    (first, last, string of each run, run of each string, copies, bucket)."""
    runs, _ = _leveled(buf, offsets, heard, anchors, need, grams)
    first, last, anchor = (np.concatenate([r[k] for r in runs]) for k in range(3))
    bucket = bucket_of(anchor, buckets).astype(np.int64)
    # an order that depends on the strings alone: by bucket, then hash
    content = span_hashes(buf, first, last + need)
    order = np.lexsort((content, bucket))
    new = np.concatenate([[True], (np.diff(bucket[order]) != 0) | (content[order][1:] != content[order][:-1])])[:len(order)]
    string = np.empty(len(order), np.int64)
    string[order] = np.cumsum(new) - 1
    run = order[new]
    return first, last, string, run, np.bincount(string, minlength=len(run)), bucket[run]


def sent_strings(docs: DataFrame, need: int, gram: int, id_col: str, text_col: str, block_bytes: int, bucket_bytes: int):
    """(blocks with what they heard of their anchors, the strings they send to the
    buckets, and the rules by which a block finds its strings again)."""
    blocks = text_blocks(docs, id_col, text_col, block_bytes)
    size = int(blocks.agg(F.sum("size")).first()[0] or 0)
    grams = gram_lengths(need, gram)
    hot = bucket_bytes // (need + (need - gram) // 2)
    anchors, told, sent_bytes = [max(64, 2 * size // (need - gram + 1) // BUCKET_ANCHORS)], None, 0
    for level, length in enumerate(grams):
        def names(buf: np.ndarray, offsets: np.ndarray, heard: list | None = None, sizes=tuple(anchors), length=length) -> np.ndarray:
            windows = _leveled(buf, offsets, heard, list(sizes[:-1]), need, grams)[1] if heard else None
            return _named(buf, _runs_of(buf, offsets, windows, need, length), need)

        last = length == need
        asking = blocks.join(told.where("n_hot > 0"), "block") if level else blocks
        heard = stable(shared_prints(asking, names, anchors[-1], "heard" if level else None, 1 << 62 if last else hot))
        n, n_hot = (int(x or 0) for x in heard.agg(F.sum("n"), F.sum("n_hot")).first())
        sent_bytes += n * (need + (need - length) // 2)
        mine = heard.select("block", F.array("heard").alias("heard"), "n_hot")
        if level:  # a block that didn't ask has nothing to look up
            before = told.select("block", F.col("heard").alias("so_far"))
            none = F.array(F.lit(None).cast(heard.schema["heard"].dataType))
            mine = before.join(mine, "block", "left").select(
                "block", F.concat("so_far", F.coalesce("heard", none)).alias("heard"), F.coalesce("n_hot", F.lit(0)).alias("n_hot"))
        told = mine
        if last or not n_hot:
            break
        # a hot string of the mean length has so many windows, and so many names at most
        following = need - grams[level + 1] + 1
        anchors.append(max(64, n_hot * (2 * (need - length + 1) // following + 1) // BUCKET_ANCHORS))
    buckets = max(64, sent_bytes // bucket_bytes)
    rules = (anchors, buckets, need, grams)
    nothing = F.array_repeat(F.lit(None).cast(heard.schema["heard"].dataType), len(anchors))
    asked = stable(blocks.join(told.drop("n_hot"), "block", "left").withColumn("heard", F.coalesce("heard", nothing)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                buf, offsets = block_texts(batch, i)
                first, last, _, run, copies, bucket = _strings(
                    buf, offsets, batch.column("heard")[i].as_py(), *rules)
                cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0])) if len(run) else []
                rows = []
                for a, b in zip(cuts, np.append(cuts[1:], len(run)) if len(run) else []):
                    r = run[a:b]
                    flat = buf[ranges(first[r], last[r] + need)].tobytes()
                    rows.append((int(bucket[a]), (last[r] + need - first[r]).astype("<i4").tobytes(),
                                 (copies[a:b] > 1).astype(np.uint8).tobytes(), zlib.compress(flat, 1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[i].as_py()] * len(rows), pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]],
                    names=["block", "bucket", "lens", "again", "flat"])

    return asked, asked.select("block", "lens", "texts", "heard").mapInArrow(
        send, "block long, bucket long, lens binary, again binary, flat binary"), rules


def remove_repeats(docs: DataFrame, need: int = NEED, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document, and with
    ``with_text`` the kept bytes and the removed spans (start, end)."""
    asked, sent, rules = sent_strings(docs, need, gram, id_col, text_col, block_bytes, bucket_bytes)

    def sort(table: pa.Table) -> pa.Table:
        strings: dict[bytes, int] = {}
        again: list[bool] = []
        asked_by = []
        for lens, many, flat in zip(*(table.column(c) for c in ("lens", "again", "flat")), strict=True):
            lens, many = np.frombuffer(lens.as_py(), "<i4").tolist(), np.frombuffer(many.as_py(), np.uint8).tolist()
            flat, at, mine = zlib.decompress(flat.as_py()), 0, []
            for n, m in zip(lens, many, strict=True):
                k = strings.setdefault(flat[at:at + n], len(strings))
                if k == len(again):
                    again.append(bool(m))
                else:
                    again[k] = True
                mine.append(k)
                at += n
            asked_by.append(mine)
        marks = repeated_windows([np.frombuffer(x, np.uint8) for x in strings], need)
        packed = [np.ones(len(m), bool) if a else m for m, a in zip(marks, again, strict=True)]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "marks": pa.array(
            [zlib.compress(np.packbits(np.concatenate([packed[k] for k in mine])).tobytes(), 1) for mine in asked_by], pa.binary())})

    told = sent.groupBy("bucket").applyInArrow(sort, "block long, bucket long, marks binary").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "marks"))).alias("told"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, null = block_ids(batch, i)
                buf, offsets = block_texts(batch, i)
                first, last, string, run, _, bucket = _strings(
                    buf, offsets, batch.column("heard")[i].as_py(), *rules)
                length = last[run] - first[run] + 1
                parts = []
                for x in batch.column("told")[i].as_py() or []:
                    n = int(length[bucket == x["bucket"]].sum())
                    parts.append(np.unpackbits(np.frombuffer(zlib.decompress(x["marks"]), np.uint8))[:n])
                marks = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
                base = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
                starts = ranges(first, last + 1)[marks[ranges(base[string], base[string + 1])].astype(bool)]
                depth = np.zeros(len(buf) + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.add.at(depth, starts + need, -1)
                gone = np.cumsum(depth)[:-1] > 0
                out = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    g = gone[a:b]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
                    kept = buf[a:b][~g].tobytes()
                    out.append((b - a, int(g.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest(), kept,
                                [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)] if with_text else None))
                cols = [pa.array(ids, mask=null), *[pa.array([o[k] for o in out], pa.int64()) for k in range(3)],
                        pa.array([o[3] for o in out], pa.string())]
                if with_text:
                    cols += [pa.array([o[4] for o in out], pa.binary()),
                             pa.array([o[5] for o in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary, spans array<struct<start: long, end: long>>" if with_text else ""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept", "spans"] if with_text else [])]
    return asked.join(told, "block", "left").select("ids", "nulls", "lens", "texts", "heard", "told").mapInArrow(cut, schema)
