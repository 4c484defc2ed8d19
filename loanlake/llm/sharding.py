"""Hierarchical weighted hash tree: region, rack, shard.

A document descends from the root: at each level every child draws ``-ln(u) / weight``
with a uniform hash ``u`` of the document id and the child's name, and the smallest draw
wins. A node weighs what its shards weigh together, so a shard gets documents by its
weight. Draws at one node don't depend on the others: where a node's weight changes,
only it gains or loses documents, and below it they are drawn anew; subtrees whose
weights stay keep all documents but those that change subtree.

A shard more opens a region of its own (``grown``), so it takes documents only into itself.

Law ``key``: the document id, the number of shards and their weights decide.
Rows that share an id, repeated rows and null ids (which hash alike) share a
shard. A null text has size 8 and the crc32 of the empty text. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered

#: The first shards stand in regions of so many racks of so many shards; later ones are regions of their own.
REGIONS, RACKS, SHARDS = 2, 3, 4

#: Shard weights by region and rack.
Tree = Sequence[Sequence[Sequence[float]]]


def layout(weights: Sequence[float]) -> list[list[list[float]]]:
    """The tree of so many shards. Fewer than the first regions hold are regions of their own."""
    weights = list(weights)
    base = REGIONS * RACKS * SHARDS
    if len(weights) < base:
        return [[[w]] for w in weights]
    racks = [weights[i:i + SHARDS] for i in range(0, base, SHARDS)]
    return [racks[i:i + RACKS] for i in range(0, len(racks), RACKS)] + [[[w]] for w in weights[base:]]


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _weight(node: object) -> float:
    return sum(map(_weight, node)) if isinstance(node, Sequence) else float(node)


def place(key: Column, tree: Tree) -> Column:
    """struct(draw, region, rack, shard): the winning region's draw and the descent's end."""
    if _weight(tree) <= 0:
        raise ValueError("no shard has a positive weight")

    def winner(name: str, children: Sequence) -> Column:
        draws = [F.struct(_draw(key, f"{name}.{i}", _weight(c)).alias("draw"), F.lit(i).alias("i"))
                 for i, c in enumerate(children) if _weight(c) > 0]
        return draws[0] if len(draws) == 1 else F.least(*draws)

    def among(chosen: Column, options: dict[int, Column]) -> Column:
        out = None
        for i, value in options.items():
            out = F.when(chosen == i, value) if out is None else out.when(chosen == i, value)
        return out

    shard_no, racks, shards, ids = 0, {}, {}, {}
    for r, region in enumerate(tree):
        for k, rack in enumerate(region):
            numbers = list(range(shard_no, shard_no + len(rack)))
            shard_no += len(rack)
            if _weight(rack) > 0:
                shards[r, k] = winner(f"{r}.{k}", rack)["i"]
                ids[r, k] = numbers[0]
        if _weight(region) > 0:
            racks[r] = winner(f"{r}", region)["i"]
    top = winner("", tree)
    region = top["i"]
    rack = among(region, racks)
    by_region = {r: among(rack, {k: s + ids[r, k] for (q, k), s in shards.items() if q == r}) for r in racks}
    return F.struct(top["draw"].alias("draw"), region.alias("region"), rack.alias("rack"), among(region, by_region).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 24, weights: Sequence[float] | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its size, checksum, region, rack (there), shard, slot in the
    shard, and the shard it would have with one shard more (of weight 1). Other columns
    are left out."""
    weights = list(weights or [1.0] * shards)
    tree = layout(weights)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col)
    base = docs.select(
        key.alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), place(key, tree).alias("_at"),
        _draw(key, f".{len(tree)}", 1.0).alias("_new"))
    placed = base.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_at.region").alias("region"),
        F.col("_at.rack").alias("rack"), F.col("_at.shard").cast("int").alias("shard"),
        F.when(F.col("_new") < F.col("_at.draw"), F.lit(len(weights))).otherwise(F.col("_at.shard"))
        .cast("int").alias("grown_shard"))
    return numbered(placed, ["shard"], ["doc_id", "text_crc32"], index="slot")
