"""Exact removal of repeated word passages by suffix automata of reference shards.

A word goes if a window of ``need`` words that covers it also starts elsewhere, in the
same or another document. The table is its own reference. It grows with the data, so
its automata can't be broadcast to every task: they are cut into shards, and each shard
meets just the passages that can match it. Each window names its anchor, the least hash
among its shorter word strings, a function of the window alone; anchors that the table
has once can't repeat. Windows of the others travel, as one passage per run of windows
with a common anchor, to the shard of that anchor's hash; equal passages of a block go
once. Windows of a hot anchor are named anew by longer word strings, up to the whole
window, so a shard stays bounded.

A shard builds one suffix automaton over its distinct passages, words as bytes compared
whole, and counts how often each state's strings end in them. Then the passages stream
through it: the state at each word gives the matching statistic, the length of the
longest string ending there that the shard has twice or more. Where it reaches ``need``,
the window's mark returns to its block, and covered words are cut as maximal spans.

``match_references`` is the same for a bounded reference table: its shards' automata are
broadcast, documents stream through all of them.

Windows are judged on the input. Words are runs of anything but ASCII white space,
unchanged. A null text has none; shorter texts keep everything. Repeated rows are copies
like any others; null ids come back as they are; other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_BYTES, WORD, bucketed, ranges, slices, spaced, span_hashes, stable, utf8, word_spans
from .exchange import BLOCK_BYTES, block_ids, block_texts, shared_prints, text_blocks
from .suffix_dedup import _leveled, _named, _runs_of, _strings

#: Words of a window, and of the strings that name it in turn.
NEED, GRAMS = 35, (8, 20, 35)
#: Anchors of a counting bucket, passage words of a shard, text bytes of a bucket of blocks.
BUCKET_ANCHORS, SHARD_WORDS, BUCKET_BYTES = 200_000, 100_000, 64 << 20
#: Words of a reference table whose automata may be broadcast.
MAX_REFERENCE_WORDS = 2_000_000


class SuffixAutomaton:
    """All substrings of the added strings, with the number of places where each ends."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _split(self, p: int, c: object, q: int) -> int:
        """A copy of state ``q`` for the strings that reach it from ``p``."""
        state = len(self.next)
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.count.append(0)
        self.link[q] = state
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = state
            p = self.link[p]
        return state

    def add(self, string: Iterable, copies: int = 1) -> None:
        nxt, link, length, count, last = self.next, self.link, self.length, self.count, 0
        for c in string:
            q = nxt[last].get(c)
            if q is None:
                state, p = len(nxt), last
                nxt.append({})
                length.append(length[last] + 1)
                count.append(0)
                link.append(0)
                while p != -1 and c not in nxt[p]:
                    nxt[p][c] = state
                    p = link[p]
                if p != -1:
                    q = nxt[p][c]
                    link[state] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = state
            else:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            count[last] += copies

    def known_lengths(self, times: int) -> list[int]:
        """For each state the length of its longest suffix that ends in ``times`` or more places."""
        link, length, count = (np.array(x, np.int64) for x in (self.link, self.length, self.count))
        order = np.argsort(length, kind="stable")[1:]
        levels = np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []
        for states in reversed(levels):
            np.add.at(count, link[states], count[states])
        known = np.zeros(len(length), np.int64)
        for states in levels:
            known[states] = np.where(count[states] >= times, length[states], known[link[states]])
        return known.tolist()

    def statistics(self, string: Iterable, known: list[int]) -> list[int]:
        """The matching statistic at each word of any string: how many words up to it the
        automaton has, as far as ``known`` allows."""
        nxt, link, length, state, have, out = self.next, self.link, self.length, 0, 0, []
        for c in string:
            while state and c not in nxt[state]:
                state = link[state]
                have = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                have += 1
            out.append(min(have, known[state]))
        return out


def block_words(buf: np.ndarray, offsets: np.ndarray):
    """(texts with single white spaces, word starts, word ends, word hashes, each text's first word)."""
    text, at = spaced(buf, offsets)
    starts, ends = word_spans(text)
    return text, starts, ends, span_hashes(text, starts, ends), np.searchsorted(starts, at)


def _one_space(text: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[list(SPACE_BYTES)] = 32
    return table[text]


def sent_passages(docs: DataFrame, need: int, grams: tuple[int, ...], id_col: str, text_col: str, block_bytes: int, shard_words: int):
    """(blocks with what they heard of their anchors, the passages they send to the
    shards, and the rules by which a block finds its passages again)."""
    spark = docs.sparkSession
    size = int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    # the texts are shuffled once, into a table that all later joins by block read in place
    blocks = bucketed(text_blocks(docs, id_col, text_col, block_bytes, fixed=False), "block", buckets)
    words, grams = size // 5, list(grams)
    hot = shard_words // (need + (need - grams[0]) // 2)
    anchors, told, sent_words = [max(64, 2 * words // (need - grams[0] + 1) // BUCKET_ANCHORS)], None, 0
    for level, length in enumerate(grams):
        def names(buf: np.ndarray, offsets: np.ndarray, heard: list | None = None, sizes=tuple(anchors), length=length) -> np.ndarray:
            _, _, _, hashes, first = block_words(buf, offsets)
            windows = _leveled(hashes, first, heard, list(sizes[:-1]), need, grams)[1] if heard else None
            return _named(hashes, _runs_of(hashes, first, windows, need, length), need)

        last = length == need
        asking = blocks.join(told.where("n_hot > 0"), "block") if level else blocks
        heard = stable(shared_prints(asking, names, anchors[-1], "heard" if level else None, 1 << 62 if last else hot))
        n, n_hot = (int(x or 0) for x in heard.agg(F.sum("n"), F.sum("n_hot")).first())
        sent_words += n * (need + (need - length) // 2)
        mine = heard.select("block", F.array("heard").alias("heard"), "n_hot")
        if level:  # a block that didn't ask has nothing to look up
            before = told.select("block", F.col("heard").alias("so_far"))
            none = F.array(F.lit(None).cast(heard.schema["heard"].dataType))
            mine = before.join(mine, "block", "left").select(
                "block", F.concat("so_far", F.coalesce("heard", none)).alias("heard"), F.coalesce("n_hot", F.lit(0)).alias("n_hot"))
        told = mine
        if last or not n_hot:
            break
        following = need - grams[level + 1] + 1
        anchors.append(max(64, n_hot * (2 * (need - length + 1) // following + 1) // BUCKET_ANCHORS))
    shards = max(64, sent_words // shard_words)
    rules = (anchors, shards, need, grams)
    nothing = F.array_repeat(F.lit(None).cast(heard.schema["heard"].dataType), len(anchors))
    asked = blocks.join(stable(told.drop("n_hot")), "block", "left").withColumn("heard", F.coalesce("heard", nothing))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, starts, ends, hashes, offsets = block_words(*block_texts(batch, i))
                first, last, _, run, copies, shard = _strings(hashes, offsets, batch.column("heard")[i].as_py(), *rules)
                text, rows = _one_space(text), []
                cuts = np.flatnonzero(np.concatenate([[True], np.diff(shard) != 0])) if len(run) else np.zeros(0, np.int64)
                for a, b in zip(cuts, np.append(cuts[1:], len(run)), strict=False):
                    r = run[a:b]
                    w = ranges(first[r], last[r] + need)
                    rows.append((int(shard[a]), (last[r] + need - first[r]).astype("<i4").tobytes(),
                                 (copies[a:b] > 1).astype(np.uint8).tobytes(), zlib.compress(text[ranges(starts[w], ends[w] + 1)].tobytes(), 1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[i].as_py()] * len(rows), pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]],
                    names=["block", "shard", "lens", "again", "words"])

    return asked, asked.select("block", "lens", "texts", "heard").mapInArrow(
        send, "block long, shard long, lens binary, again binary, words binary"), rules


def repeated_passages(passages: dict[tuple, int], need: int) -> list[np.ndarray]:
    """For each of these distinct passages with its copies (2 stands for more), which of
    its windows occur again, in it or in another."""
    automaton = SuffixAutomaton()
    for passage, copies in passages.items():
        automaton.add(passage, copies)
    known = automaton.known_lengths(2)
    return [np.array(automaton.statistics(p, known)[need - 1:]) >= need for p in passages]


def _cover(n: int, starts: np.ndarray, need: int) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + need, -1)
    return np.cumsum(depth)[:-1] > 0


def remove_passages(docs: DataFrame, need: int = NEED, grams: tuple[int, ...] = GRAMS, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, with_text: bool = False, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document, and with ``with_text``
    the kept words joined by spaces and the removed spans (start, end) in words. ``grams``
    rise from the shortest naming string to ``need``."""
    asked, sent, rules = sent_passages(docs, need, grams, id_col, text_col, block_bytes, shard_words)

    def match(table: pa.Table) -> pa.Table:
        ids: dict[bytes, int] = {}
        passages: dict[tuple, int] = {}
        number: dict[tuple, int] = {}
        asked_by = []
        for lens, many, words in zip(*(table.column(c) for c in ("lens", "again", "words")), strict=True):
            lens, many = np.frombuffer(lens.as_py(), "<i4").tolist(), np.frombuffer(many.as_py(), np.uint8).tolist()
            coded, at, mine = [ids.setdefault(w, len(ids)) for w in zlib.decompress(words.as_py()).split(b" ")], 0, []
            for n, m in zip(lens, many, strict=True):
                passage = tuple(coded[at:at + n])
                passages[passage] = 2 if m or passage in passages else 1
                mine.append(number.setdefault(passage, len(number)))
                at += n
            asked_by.append(mine)
        marks = repeated_passages(passages, need)
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "marks": pa.array(
            [zlib.compress(np.packbits(np.concatenate([marks[k] for k in mine])).tobytes(), 1) for mine in asked_by], pa.binary())})

    told = sent.groupBy("shard").applyInArrow(match, "block long, shard long, marks binary").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("shard", "marks"))).alias("told"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, null = block_ids(batch, i)
                text, starts, ends, hashes, offsets = block_words(*block_texts(batch, i))
                first, last, string, run, _, shard = _strings(hashes, offsets, batch.column("heard")[i].as_py(), *rules)
                length = last[run] - first[run] + 1
                parts = []
                for x in batch.column("told")[i].as_py() or []:
                    n = int(length[shard == x["shard"]].sum())
                    parts.append(np.unpackbits(np.frombuffer(zlib.decompress(x["marks"]), np.uint8))[:n])
                marks = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
                base = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
                windows = ranges(first, last + 1)[marks[ranges(base[string], base[string + 1])].astype(bool)]
                gone, text, out = _cover(len(hashes), windows, need), _one_space(text), []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    g = gone[a:b]
                    keep = np.flatnonzero(~g) + a
                    kept = text[ranges(starts[keep], ends[keep] + 1)].tobytes()[:-1]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
                    out.append((b - a, int(g.sum()), hashlib.sha256(kept).hexdigest(), kept,
                                [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)] if with_text else None))
                cols = [pa.array(ids, mask=null), *[pa.array([o[k] for o in out], pa.int64()) for k in range(2)],
                        pa.array([o[2] for o in out], pa.string())]
                if with_text:
                    cols += [pa.array([o[3] for o in out], pa.binary()),
                             pa.array([o[4] for o in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    schema += ", kept binary, spans array<struct<start: long, end: long>>" if with_text else ""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept", "spans"] if with_text else [])]
    return asked.join(told, "block", "left").select("ids", "nulls", "lens", "texts", "heard", "told").mapInArrow(cut, schema)


def match_references(docs: DataFrame, references: DataFrame, need: int = NEED, id_col: str = "doc_id", text_col: str = "text",
                     reference_col: str = "text", shard_words: int = SHARD_WORDS, max_words: int = MAX_REFERENCE_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept text and removed spans (start, end in words) of every
    document against the texts of a bounded reference table, of at most ``max_words`` words."""
    texts = references.select(F.col(reference_col).alias("text")).where("text is not null")
    n = int(texts.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0)
    if n > max_words:
        raise ValueError(f"the references have {n} words, more than {max_words}; remove_passages takes unbounded tables")
    shards, size = [[]], 0
    for r in texts.orderBy("text").collect():  # bounded by the check above
        words = r["text"].encode().translate(bytes.maketrans(SPACE_BYTES, b" " * len(SPACE_BYTES))).split(b" ")
        words = [w for w in words if w]
        if size and size + len(words) > shard_words:
            shards.append([])
            size = 0
        shards[-1].append(words)
        size += len(words)
    sent = docs.sparkSession.sparkContext.broadcast(shards)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = []
        for passages in sent.value:
            automaton = SuffixAutomaton()
            for p in passages:
                automaton.add(p)
            automata.append((automaton, automaton.known_lengths(1)))
        for batch in batches:
            buf, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets, BLOCK_BYTES):
                text, starts, ends, _, first = block_words(buf, offsets[lo:hi + 1])
                raw, out = text.tobytes(), []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    words = [raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                    seen = np.zeros(len(words), np.int64)
                    for automaton, known in automata:
                        seen = np.maximum(seen, automaton.statistics(words, known))
                    gone = _cover(len(words), np.flatnonzero(seen >= need) - need + 1, need)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    out.append((len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode("utf-8", "replace"),
                                [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)]))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), *[pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)],
                    pa.array([o[2] for o in out], pa.string()),
                    pa.array([o[3] for o in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=["doc_id", "n_words", "n_removed", "kept", "spans"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        match, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>")
