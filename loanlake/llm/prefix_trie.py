"""The trie of conversation prefixes, by a splitter skeleton over range partitions.

A conversation is a path: one ``WIDTH``-byte digest of role and text per turn. Paths
are range-partitioned and sorted. A trie node lies in several partitions only if it is
a prefix of a path at a partition's edge, so the trie of these splitter paths (as deep
as both sides of an edge share them), the skeleton, is broadcast; its size is bounded
by partitions times ``segment``. Each task walks its sorted shard with a stack as deep
as a path, finishes every node outside the skeleton, and sends one partial aggregate
per skeleton node. Partials are summed per node, then added up along the skeleton.

A path longer than ``segment`` turns is cut; the later segments form tries of their own
under the digest of all that comes before, walked from the deepest level up, so neither
a conversation nor a node's members are ever gathered in one row or one task's memory.
The ids of the conversations that end at a node are hashed as a stream in rising order.

Conversations are integers; rows without ``conv_id`` belong to none and take no part.
Null role or text is empty, a null turn comes first, ties in turn go by role, then text;
repeated rows are turns like others. Columns beyond the four are ignored. A conversation
without turns is a member of the root; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stable

#: Bytes of a turn's digest, turns of a path's segment, ids of one piece of a hash stream.
WIDTH, SEGMENT, PIECE = 16, 4096, 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

_WALK = ("kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, turn_digest binary, at long, at_depth long, size long, piece string")
_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_digest")


def shared_turns(a: bytes, b: bytes) -> int:
    """How many leading turns two paths share."""
    lo, hi = 0, min(len(a), len(b)) // WIDTH
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * WIDTH:mid * WIDTH] == b[lo * WIDTH:mid * WIDTH]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Skeleton:
    """The trie of the splitter paths. A node is named by the first of the sorted
    splitters that has it, and its depth; names in order are the trie in preorder."""

    def __init__(self, paths: list[bytes]):
        self.paths = sorted({b"", *paths})
        self.shared = [-1] + [shared_turns(a, b) for a, b in zip(self.paths, self.paths[1:])]

    def deepest(self, path: bytes) -> tuple[int, int]:
        """(a splitter, depth) of the deepest skeleton node on a path."""
        i = bisect_left(self.paths, path)
        return max(((j, shared_turns(self.paths[j], path)) for j in (i - 1, i) if 0 <= j < len(self.paths)),
                   key=lambda x: x[1])

    def name(self, splitter: int, depth: int) -> tuple[int, int]:
        while depth <= self.shared[splitter]:
            splitter -= 1
        return splitter, depth

    def parent(self, name: tuple[int, int]) -> tuple[int, int] | None:
        return self.name(name[0], name[1] - 1) if name[1] else None


class _Node:
    __slots__ = ("name", "depth", "digest", "size", "n", "conv", "children", "leaves", "saved", "ends", "told", "rows", "ids")

    def __init__(self, name, depth, digest, size):
        self.name, self.depth, self.digest, self.size = name, depth, digest, size
        self.n = self.children = self.leaves = self.saved = 0
        self.conv = self.ends = self.told = None
        self.rows, self.ids = [], []


class _Walk:
    """One shard's walk over sorted (conv_id, path, sizes, below) rows."""

    def __init__(self, skeleton: Skeleton, full: int, shift: int, piece: int):
        self.skeleton, self.full, self.shift, self.piece = skeleton, full, shift, piece
        self.stack: list[_Node] = []
        self.path, self.out = b"", []

    def add(self, conv: int, path: bytes, sizes: list[int], below: dict | None) -> None:
        depth = len(path) // WIDTH
        shared = shared_turns(self.path, path) if self.stack else -1
        while len(self.stack) > shared + 1:
            self._close()
        if depth > shared:
            splitter, known = self.skeleton.deepest(path)
            for d in range(shared + 1, depth + 1):
                name = self.skeleton.name(splitter, d) if d <= known else None
                self.stack.append(_Node(name, d, path[(d - 1) * WIDTH:d * WIDTH] if d else None, sizes[d - 1] if d else 0))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.conv = conv if node.conv is None else min(conv, node.conv)
        if depth == self.full:  # goes on in the next segment, whose root told what lies below
            if below is not None:
                node.children += below["n_children"]
                node.leaves += below["n_leaves"]
                node.saved += below["saved_tokens"]
                node.told = below["ends_sha256"]
        else:
            node.ids.append(conv)
            if len(node.ids) >= self.piece:
                self._spill(node)

    def _spill(self, node: _Node) -> None:
        text = ",".join(map(str, node.ids))
        if node.name is None:
            fresh = node.ends is None
            node.ends = hashlib.sha256() if fresh else node.ends
            node.ends.update((text if fresh else "," + text).encode())
        elif node.ids:
            self.out.append(("ends", node.ids[0], None, None, None, None, None, None, None, None, *node.name, None, text))
        node.ids = []

    def _close(self) -> None:
        node = self.stack.pop()
        parent = self.stack[-1] if self.stack else None
        if node.ids:
            self._spill(node)
        if parent is not None:
            parent.n += node.n
            parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
        if node.name is not None:
            self.out.append(("part", node.conv, node.depth + self.shift, None, node.n, node.children, node.leaves, node.saved,
                             node.told, node.digest, *node.name, node.size, None))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.size
        ends = node.told or (node.ends.hexdigest() if node.ends else NO_ENDS)
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        row = (node.conv, node.depth + self.shift, node.n, node.children, leaves, saved, ends, node.digest)
        if parent.name is not None:
            self._emit(row, None, parent.name)
        else:
            parent.rows.append(row)
        for child in node.rows:
            self._emit(child, node.conv, (None, None))

    def _emit(self, row: tuple, parent_conv: int | None, at: tuple) -> None:
        self.out.append(("node", row[0], row[1], parent_conv, *row[2:], *at, None, None))

    def finish(self) -> None:
        while self.stack:
            self._close()


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(names))], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = batch.column("path")[0].as_py() if first is None else first
            last = batch.column("path")[batch.num_rows - 1].as_py()
    if first is not None:
        yield pa.RecordBatch.from_arrays([pa.array([first], pa.binary()), pa.array([last], pa.binary())], names=["first", "last"])


def _level(rows: DataFrame, segment: int, level: int, partitions: int | None, piece: int) -> tuple[DataFrame, DataFrame | None]:
    """(nodes of one level of segments, what its roots tell the level above)."""
    skip = 1 if level else 0
    shift, full = level * segment - skip, segment + skip
    by = [*([partitions] if partitions else []), "path", "conv_id"]
    sorted_rows = stable(rows.repartitionByRange(*by).sortWithinPartitions("path", "conv_id"))
    # one row per partition
    edges = sorted(map(tuple, sorted_rows.select("path").mapInArrow(_edges, "first binary, last binary").collect()))
    skeleton = Skeleton([bytes(b[0][:shared_turns(bytes(a[1]), bytes(b[0])) * WIDTH]) for a, b in zip(edges, edges[1:])])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_WALK)
        task = _Walk(skeleton, full, shift, piece)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes", "below")), strict=True):
                task.add(*row)
                if len(task.out) >= 20_000:
                    yield _batch(task.out, schema.names, schema)
                    task.out = []
        task.finish()
        yield _batch(task.out, schema.names, schema)

    walked = stable(sorted_rows.select("conv_id", "path", "sizes", "below").mapInArrow(walk, _WALK))

    def ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, at, hashed, done = ["at", "at_depth", "ends"], None, None, []
        for batch in batches:
            for s, d, text in zip(*(batch.column(c).to_pylist() for c in ("at", "at_depth", "piece")), strict=True):
                if (s, d) != at:
                    if at is not None:
                        done.append((*at, hashed.hexdigest()))
                    at, hashed = (s, d), hashlib.sha256(text.encode())
                else:
                    hashed.update(("," + text).encode())
        if at is not None:
            done.append((*at, hashed.hexdigest()))
        schema = _arrow("at long, at_depth long, ends string")
        yield _batch(done, names, schema)

    ends = (walked.where("kind = 'ends'").select("at", "at_depth", "conv_id", "piece").repartition("at", "at_depth")
            .sortWithinPartitions("at", "at_depth", "conv_id").drop("conv_id").mapInArrow(ends_of, "at long, at_depth long, ends string"))
    parts = walked.where("kind = 'part'").groupBy("at", "at_depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends_sha256").alias("told"), F.max("turn_digest").alias("turn_digest"), F.max("size").alias("size"))
    whole = parts.join(ends, ["at", "at_depth"], "left")
    whole = whole.withColumn("ends_sha256", F.coalesce("told", "ends", F.lit(NO_ENDS))).drop("told", "ends")
    fields = [f for f in _WALK.split(", ") if f.split()[0] not in ("kind", "size", "piece")]

    def add_up(table: pa.Table) -> pa.Table:
        nodes = {(r["at"], r["at_depth"]): r for r in table.to_pylist()}
        for name in sorted(nodes, reverse=True):  # reversed preorder: children before parents
            node = nodes[name]
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
            up = skeleton.parent(name)
            node["parent_conv_id"] = nodes[up]["conv_id"] if up else None
            if up:
                nodes[up]["n_children"] += 1
                nodes[up]["n_leaves"] += node["n_leaves"]
                nodes[up]["saved_tokens"] += node["saved_tokens"]
        schema = _arrow(", ".join(fields))
        return pa.Table.from_pylist(list(nodes.values()), schema=schema)

    # one row per skeleton node, at most partitions x segment
    skeleton_rows = stable(whole.groupBy(F.lit(0).alias("skeleton")).applyInArrow(add_up, ", ".join(fields)))
    heads = F.broadcast(skeleton_rows.select("at", "at_depth", F.col("conv_id").alias("head")))
    local = walked.where("kind = 'node'").join(heads, ["at", "at_depth"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "head"))
    both = local.select(*_NODE).unionByName(skeleton_rows.select(*_NODE))
    if not level:
        return both, None
    roots = both.where(F.col("depth") == level * segment)
    below = roots.select(F.col("turn_digest").alias("next_root"), F.col("conv_id").alias("first_conv"), F.struct(
        "n_children", F.expr("if(n_children = 0, 0L, n_leaves)").alias("n_leaves"), "saved_tokens", "ends_sha256").alias("below"))
    return both.where(F.col("depth") > level * segment), below


def prefix_trie(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT, partitions: int | None = None,
                piece: int = PIECE) -> DataFrame:
    """The nodes of the trie of conversations given as ``turns`` (conv_id, gapless ``pos``,
    ``digest`` of ``WIDTH`` bytes, ``size``) and ``lengths`` (conv_id, ``length``, 0 for one
    without turns). Beside the counts each node has the digest of its last turn."""
    segs = turns.groupBy("conv_id", F.expr(f"pos div {segment}").alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.hex("digest").alias("digest"), "size"))).alias("t"))
    every = lengths.select("conv_id", F.explode(F.expr(f"sequence(0L, length div {segment})")).alias("seg"))
    rows = every.join(segs, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", F.coalesce(F.unhex(F.array_join("t.digest", "")), F.lit(b"")).alias("path"),
        F.coalesce(F.col("t.size"), F.expr("array()").cast("array<long>")).alias("sizes"))
    nothing = F.lit(None).cast("struct<n_children: long, n_leaves: long, saved_tokens: long, ends_sha256: string>").alias("below")
    deepest = lengths.agg(F.max(F.expr(f"length div {segment}"))).first()[0]
    if not deepest:
        return _level(rows.select("conv_id", "path", "sizes", nothing), segment, 0, partitions, piece)[0]
    # a later segment hangs under the digest of all segments before it
    rows = stable(rows)
    order = Window.partitionBy("conv_id").orderBy("seg")
    before = F.array_join(F.collect_list("mine").over(order.rowsBetween(Window.unboundedPreceding, -1)), "")
    root = F.when(F.col("seg") > 0, F.unhex(F.substring(F.sha2(before.cast("binary"), 256), 1, 2 * WIDTH)))
    roots = rows.select("conv_id", "seg", F.sha2("path", 256).alias("mine")).withColumn("root", root)
    roots = roots.withColumn("next_root", F.lead("root").over(order)).drop("mine")
    rows = stable(rows.join(roots, ["conv_id", "seg"]))
    out, below = [], None
    for level in range(deepest, -1, -1):
        mine = rows.where(F.col("seg") == level)
        if below is None:
            mine = mine.withColumn("below", nothing)
        else:
            told = below.withColumnRenamed("first_conv", "conv_id")
            mine = mine.join(told, ["next_root", "conv_id"], "left")
        if level:
            mine = mine.withColumn("path", F.concat("root", "path")).withColumn("sizes", F.concat(F.array(F.lit(0).cast("long")), "sizes"))
        nodes, below = _level(mine.select("conv_id", "path", "sizes", "below"), segment, level, partitions, piece)
        out.append(nodes)
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0 in its conversation), digest and size (UTF-8 bytes of the text) of every turn."""
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return numbered(t, ["conv_id"], ["turn", "role", "text"], index="pos").select(
        "conv_id", "pos", F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * WIDTH)).alias("digest"),
        F.octet_length("text").cast("long").alias("size"))


def share_heads(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt (turns, lengths): conversation c starts with the first h turns of c - c % family
    (all if fewer), h = crc32 of its decimal id % heads, and goes on with its own turns after its first h."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(base, "base", "left").select(
        "conv_id", "base", "n", F.expr(f"crc32(cast(cast(conv_id as string) as binary)) % {heads}").alias("h"),
        F.coalesce("n_base", F.lit(0)).alias("n_base"))
    plan = stable(plan.withColumn("k", F.least("h", "n_base")).withColumn("length", F.expr("k + greatest(0L, n - h)")))
    rest = turns.join(plan.select("conv_id", "h", "k"), "conv_id").where("pos >= h").select(
        "conv_id", F.expr("k + pos - h").alias("pos"), "digest", "size")
    lent = turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base").join(
        plan.where("k > 0").select("conv_id", "base", "k"), "base").where("pos < k").select("conv_id", "pos", "digest", "size")
    return rest.unionByName(lent), plan.select("conv_id", "length")
