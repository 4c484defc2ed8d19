"""N-gram Jaccard self-join by prefix trees.

A document is its set of distinct five-word shingles (fewer words: the whole
sequence), as 64-bit hashes. Two documents link when 4 * |A n B| >= 3 * |A u B|.

1. Blocks of documents send the distinct shingles of the block, as fingerprints
   in hash-range buckets, to be counted, and hear back which occur in two
   documents or more. A set with under three quarters of such shingles can link
   to nothing and leaves here.
2. Shingles are ordered globally by document frequency, then hash; copies of a
   set are folded into the least document id. Linked sets share a shingle among
   the first |A| - ceil(3|A|/4) + 1 of each. Documents that share such a shingle
   meet at the least document of the shingle's group, in chunks of bounded size.
3. A chunk stores its sets in a path-compressed prefix tree, most frequent
   shingle first, so that alike sets share their paths. One traversal per set
   counts overlaps once for all sets below an edge, and leaves subtrees that
   can't reach the overlap their smallest size asks for, or that hold nothing
   but sets already in its component.
4. Where a group takes several chunks, pairs of chunks meet in a second round,
   but for chunks that lie in one component: no link between components is lost
   and a hot group of near copies never meets pairwise.

Rows with null or wordless text have no shingles and link with nothing. Rows
that share an id are one node. Rows with a null id link with nothing and have a
null component. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, mix64, numbered, ranges, shielded, span_hashes, spaced, stable, word_spans, written
from .components import components
from .exchange import BLOCK_BYTES, block_ids, block_texts, frequency, shared_prints, text_blocks

WORDS_PER_SHINGLE = 5
#: Shingles of a counting bucket and of a chunk.
BUCKET_SHINGLES, CHUNK_SHINGLES = 500_000, 50_000


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int = WORDS_PER_SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    text, at = spaced(buf, offsets)
    text[(text >= 65) & (text <= 90)] += 32
    starts, ends = word_spans(text)
    words = span_hashes(text, starts, ends)
    first = np.searchsorted(starts, at)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            rolled = mix64(rolled * np.uint64(0x100000001B3) + words[k:len(words) - width + 1 + k])
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= width:
            out.append(np.unique(rolled[lo:hi - width + 1]))
        elif hi > lo:
            h = np.full(1, hi - lo, np.uint64)
            for k in range(lo, hi):
                h = mix64(h * np.uint64(0x100000001B3) + words[k:k + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _all_shingles(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *shingle_sets(buf, offsets)])


def _sets(blocks: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, tokens) of every document: a 128-bit digest of the set
    and, if the set can link at all, its shingles that others have, in the global order
    (8 bits of frequency class above 56 bits of hash)."""
    heard = shared_prints(blocks, _all_shingles, buckets)
    joined = blocks.join(heard, "block", "left").select("ids", "nulls", "lens", "texts", "heard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, null = block_ids(batch, i)
                sets = shingle_sets(*block_texts(batch, i))
                sizes = np.array([len(s) for s in sets], np.int64)
                freq = frequency(np.concatenate(sets), batch.column("heard")[i].as_py(), buckets)
                ends = np.cumsum(sizes)
                shared = np.concatenate([[0], np.cumsum(freq > 0)])
                able = 4 * (shared[ends] - shared[ends - sizes]) >= 3 * sizes
                tokens, digests = [], []
                for s, n, e, ok in zip(sets, sizes.tolist(), ends.tolist(), able.tolist(), strict=True):
                    digests.append((int(s.sum(dtype=np.uint64).astype(np.int64)),
                                    int(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))))
                    f = freq[e - n:e]
                    t = (f[f > 0].astype(np.uint64) << np.uint64(56)) | (s[f > 0] >> np.uint64(8)) if ok and n else None
                    tokens.append(None if t is None else np.sort(t).astype("<u8").tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, mask=null), pa.array(sizes), pa.array([d for d, _ in digests], pa.int64()),
                    pa.array([d for _, d in digests], pa.int64()), pa.array(tokens, pa.binary())],
                    names=["doc_id", "n_shingles", "d1", "d2", "tokens"])

    return stable(joined.mapInArrow(read, "doc_id long, n_shingles long, d1 long, d2 long, tokens binary"))


class Trie:
    """Path-compressed prefix tree over sorted token lists, in arrays."""

    def __init__(self, lists: list[np.ndarray], sizes: np.ndarray):
        self.flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        base = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        spans, parent, stack = [(0, 0)], [-1], [(0, 0)]  # stack: (node, depth at its end)
        leaf = np.zeros(len(lists), np.int64)
        for i, x in enumerate(lists):
            common = 0
            if i:
                m = min(len(x), len(lists[i - 1]))
                differ = np.flatnonzero(x[:m] != lists[i - 1][:m])
                common = int(differ[0]) if len(differ) else m
            last = None
            while stack[-1][1] > common:
                last = stack.pop()
            if stack[-1][1] < common:  # split the edge that was left in the middle
                node, depth = last
                lo, hi = spans[node]
                mid = hi - (depth - common)
                spans.append((lo, mid))
                parent.append(parent[node])
                spans[node], parent[node] = (mid, hi), len(spans) - 1
                stack.append((len(spans) - 1, common))
            if len(x) > common:
                spans.append((int(base[i]) + common, int(base[i + 1])))
                parent.append(stack[-1][0])
                stack.append((len(spans) - 1, len(x)))
            leaf[i] = stack[-1][0]
        self.lo, self.hi = (np.array(c, np.int64) for c in zip(*spans, strict=True))
        self.parent, self.leaf = np.array(parent, np.int64), leaf
        n = len(spans)
        order = np.argsort(self.parent, kind="stable")
        self.child = order
        self.first = np.searchsorted(self.parent[order], np.arange(n + 1))
        self.depth_order = self._by_depth(n)
        self.least = np.full(n, np.iinfo(np.int64).max)  # smallest set size below
        np.minimum.at(self.least, leaf, sizes)
        self.below = np.zeros(n, np.int64)  # most tokens on a path below the node
        for v in self.depth_order[::-1].tolist():
            p = parent[v]
            if p >= 0:
                self.least[p] = min(self.least[p], self.least[v])
                self.below[p] = max(self.below[p], self.below[v] + self.hi[v] - self.lo[v])
        at = np.argsort(leaf, kind="stable")
        self.sets_at, self.sets_first = at, np.searchsorted(leaf[at], np.arange(n + 1))

    def _by_depth(self, n: int) -> np.ndarray:
        levels, now = [], np.zeros(1, np.int64)
        while len(now):
            levels.append(now)
            now = self.children(now)
        return np.concatenate(levels)

    def children(self, nodes: np.ndarray) -> np.ndarray:
        a, b = self.first[nodes], self.first[nodes + 1]
        return self.child[ranges(a, b)]

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """The label of all sets below a node, -1 where they differ."""
        out = np.full(len(self.lo), -2, np.int64)
        for i, v in enumerate(self.leaf.tolist()):
            out[v] = label[i] if out[v] in (-2, label[i]) else -1
        for v in self.depth_order[::-1].tolist():
            p = self.parent[v]
            if p >= 0:
                out[p] = out[v] if out[p] in (-2, out[v]) else -1
        return out


def trie_links(sizes: np.ndarray, tokens: list[np.ndarray], label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sets (by position) that connect all that links connect. ``label``:
    sets known to be connected; pairs within a label are not looked at."""
    every, local = np.unique(np.concatenate(tokens), return_inverse=True)
    local = len(every) - 1 - local  # most frequent first
    cuts = np.cumsum([len(t) for t in tokens])[:-1]
    lists = [np.sort(x) for x in np.split(local, cuts)]
    order = sorted(range(len(lists)), key=lambda i: lists[i].astype(">u4").tobytes())
    lists, size = [lists[i] for i in order], sizes[order]
    root = list(range(len(order)))
    if label is not None:
        first: dict[int, int] = {}
        root = [first.setdefault(x, i) for i, x in enumerate(label[order].tolist())]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []

    def link(i: int, j: int) -> None:
        out.append((order[i], order[j]))
        root[find(i)] = find(j)

    mask = np.zeros(len(every), bool)
    for i in range(1, len(order)):  # neighbours in the tree's order are the likeliest
        if find(i) != find(i - 1):
            mask[lists[i]] = True
            if 7 * int(np.count_nonzero(mask[lists[i - 1]])) >= 3 * int(size[i] + size[i - 1]):
                link(i, i - 1)
            mask[lists[i]] = False
    labels = np.array([find(i) for i in range(len(order))])
    if (labels == labels[0]).all():
        return out
    trie = Trie(lists, size)
    uniform = trie.uniform(labels)
    for i, x in enumerate(lists):
        mask[x] = True
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(nodes):
            ends = trie.sets_first[nodes + 1] - trie.sets_first[nodes]
            if ends.any():
                hits = trie.sets_at[ranges(trie.sets_first[nodes], trie.sets_first[nodes + 1])]
                over = np.repeat(overlap, ends)
                for j in hits[(7 * over >= 3 * (size[i] + size[hits])) & (hits < i)].tolist():
                    if find(i) != find(j):
                        link(i, j)
            below = trie.first[nodes + 1] - trie.first[nodes]
            over = np.repeat(overlap, below)
            nodes = trie.children(nodes)
            if not len(nodes):
                break
            length = trie.hi[nodes] - trie.lo[nodes]
            inside = mask[trie.flat[ranges(trie.lo[nodes], trie.hi[nodes])]]
            upto = np.concatenate([[0], np.cumsum(inside)])
            ends = np.cumsum(length)
            over = over + upto[ends] - upto[ends - length]
            reach = over + np.minimum(trie.below[nodes], len(x) - over)
            stay = (7 * reach >= 3 * (size[i] + trie.least[nodes])) & (uniform[nodes] != labels[i])
            nodes, overlap = nodes[stay], over[stay]
        mask[x] = False
    return out


def _tries(groups: DataFrame, keys: list[str]) -> DataFrame:
    """(a, b) reps that connect what links connect within each group of (rep, n, tokens[, component]) rows."""
    def join(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_numpy()
        keep = np.unique(reps, return_index=True)[1]
        if "digest" in table.column_names:  # rows that share an id but not a set
            keep = np.unique(np.stack([reps, table.column("digest").to_numpy()], 1), axis=0, return_index=True)[1]
        reps = reps[keep]
        sizes = table.column("n").to_numpy()[keep]
        tokens = [np.frombuffer(table.column("tokens")[int(i)].as_py(), "<u8") for i in keep]
        label = table.column("component").to_numpy()[keep] if "component" in table.column_names else None
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        for i, j in trie_links(sizes, tokens, label) if len(keep) > 1 else []:
            a, b = sorted((find(int(reps[i])), find(int(reps[j]))))
            root[b] = a
        # a star around the least of each component
        return pa.table({"a": pa.array(list(root), pa.int64()), "b": pa.array([find(x) for x in root], pa.int64())})

    return groups.groupBy(*keys).applyInArrow(join, "a long, b long")


def _meetings(reps: DataFrame) -> DataFrame:
    """(key, rep): the sets that share a leading shingle with others, at the least of those."""
    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, n, raw in zip(*(batch.column(c).to_pylist() for c in ("rep", "n", "tokens")), strict=True):
                t = np.frombuffer(raw, "<i8")
                t = t[:n + (-3 * n // 4) + 1 - (n - len(t))]
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(np.full(len(t), rep), pa.int64())],
                                                 names=["token", "rep"])

    postings = reps.select("rep", "n", "tokens").mapInArrow(lead, "token long, rep long")
    least = stable(postings.groupBy("token").agg(F.min("rep").alias("key"), F.max("rep").alias("most"))
                   .where("key < most").select("token", "key"))
    meet = postings.join(least, "token").select("key", "rep").distinct()
    return stable(meet)


def _links(reps: DataFrame, chunk_shingles: int) -> DataFrame:
    """(a, b) links that connect what links connect."""
    payload = reps.select("rep", "n", "tokens", F.col("d1").alias("digest"))
    meet = _meetings(reps)
    sized = meet.join(reps.select("rep", F.expr("octet_length(tokens) div 8").alias("len")), "rep")
    sized = stable(sized)
    chunks = stable(sized.groupBy("key").agg(
        F.ceil(F.sum("len") / F.lit(chunk_shingles)).cast("int").alias("chunks")))
    dealt = stable(sized.join(chunks, "key").select("key", "rep", "len", "chunks",
                                                    F.pmod(F.xxhash64("rep"), "chunks").alias("chunk")))
    # every chunk also gets the key's own set
    keys = chunks.select("key", F.col("key").alias("rep"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).alias("chunk"))
    first = dealt.select("key", "rep", "chunk").unionByName(keys).distinct()
    edges = written(_tries(first.join(payload, "rep"), ["key", "chunk"]))
    split = dealt.where("chunks > 1")
    if split.isEmpty():
        return edges
    labels = components(edges)
    named = stable(split.join(labels, split["rep"] == labels["node"], "left").select(
        "key", "rep", "len", F.coalesce("component", "rep").alias("component")))
    whole = named.groupBy("key", "component").agg(F.sum("len").alias("sum"))
    # a component that fills half a chunk gets cells of its own, the others of a key share some
    cells = whole.withColumn("own", F.col("sum") * 2 > chunk_shingles)
    rest = cells.groupBy("key").agg(F.sum(F.when(~F.col("own"), F.col("sum"))).alias("rest"), F.count("*").alias("parts"))
    cells = stable(cells.join(rest, "key").where("parts > 1").select(
        "key", "component", "own", F.when(F.col("own"), F.col("component")).otherwise(0).alias("owner"),
        F.ceil(F.when(F.col("own"), F.col("sum")).otherwise(F.col("rest")) / F.lit(chunk_shingles)).cast("int").alias("cells")))
    placed = stable(named.join(cells, ["key", "component"]).select(
        "key", "rep", "component", "own", "owner",
        F.pmod(F.xxhash64(F.when(F.col("own"), F.col("rep")).otherwise(F.col("component"))), "cells").alias("cell")))
    cell = placed.select("key", F.struct("own", "owner", "cell").alias("id")).distinct()
    other = cell.select("key", F.col("id").alias("id2"))
    one = F.col("id.own") & F.col("id2.own") & (F.col("id.owner") == F.col("id2.owner"))
    tasks = stable(cell.join(other, "key").where((F.col("id") <= F.col("id2")) & ~one)
                   .withColumn("task", F.monotonically_increasing_id()))
    sides = tasks.select("key", "task", F.explode(F.array_distinct(F.array("id", "id2"))).alias("at")).select(
        "key", "task", "at.own", "at.owner", "at.cell")
    joined = placed.join(sides, ["key", "own", "owner", "cell"]).select("task", "rep", "component")
    more = _tries(joined.join(payload, "rep"), ["task"])
    return written(edges.unionByName(more))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                       bucket_shingles: int = BUCKET_SHINGLES, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id (the least id reachable by links) of every row."""
    blocks = text_blocks(docs, id_col, text_col, block_bytes)
    # running text has a word, and so a shingle, about every six bytes
    size = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(64, size // 6 // bucket_shingles)
    sets = _sets(blocks, buckets)
    able = sets.where("tokens is not null and doc_id is not null")
    reps = stable(able.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens")))
    rows = sets.select("doc_id", "n_shingles", F.col("d1").alias("_1"), F.col("d2").alias("_2"), (
        F.col("tokens").isNotNull() & F.col("doc_id").isNotNull()).alias("able"))
    named = reps.select("d1", "d2", "rep")
    rows = stable(rows.join(named, (F.col("_1") == F.col("d1")) & (F.col("_2") == F.col("d2")) & F.col("able"), "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")))
    # rows of one id are one node
    ids = stable(rows.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("most")).where("a < most").select("doc_id", "a"))
    same = rows.where("n_shingles > 0").join(ids, "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct()
    found = stable(components(_links(reps, chunk_shingles).unionByName(same)))
    return rows.join(found, rows["rep"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id")).alias("component_id"))


def _with_nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a ``node``: its id, but where an id is reused for other texts a number of its own."""
    hashed = docs.withColumn("h1", F.xxhash64(text_col)).withColumn("h2", F.xxhash64(F.lit(11), text_col))
    key = [id_col, "h1", "h2"]
    keys = stable(hashed.select(*key).distinct())
    reused = stable(keys.groupBy(id_col).count().where("count > 1").select(id_col))
    if reused.isEmpty():
        return docs.withColumn("node", F.col(id_col).cast("long"))
    least, most = keys.agg(F.min(id_col), F.max(id_col)).first()
    odd = numbered(keys.join(reused, id_col, "left_semi"), [], key)
    number = F.lit(most + 1) + F.col("idx") if most < 1 << 62 else F.lit(least - 1) - F.col("idx")
    odd = stable(odd.select(*key, number.cast("long").alias("node")))
    one = hashed.join(reused, id_col, "left_anti").withColumn("node", F.col(id_col).cast("long"))
    return one.unionByName(hashed.join(odd, key)).drop("h1", "h2")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one of the least id, and of repeated
    rows the least row. Texts that reuse an id are documents each for itself. Rows without
    words or without an id all stay."""
    return shielded(docs, [id_col, text_col], lambda d: _kept(d, id_col, text_col, options)).select(*[f"`{c}`" for c in docs.columns])


def _kept(docs: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    worded = F.coalesce(F.rlike(F.col(text_col), F.lit(WORD)), F.lit(False)) & F.col(id_col).isNotNull()
    nodes = _with_nodes(docs.where(worded), id_col, text_col)
    found = stable(jaccard_components(nodes, "node", text_col, **options).where("n_shingles > 0"))
    out = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    several = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("gone")).count().where("count > 1").select("gone")
    leave = stable(out.unionByName(several))
    kept = nodes.join(leave, F.col("node") == F.col("gone"), "left_anti").drop("node")
    one = nodes.join(several, F.col("node") == F.col("gone"), "left_semi").groupBy("node").agg(
        F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return kept.unionByName(docs.where(~worded)).unionByName(one)
