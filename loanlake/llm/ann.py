"""Nearest neighbours by collision counting over single-projection sorted arrays.

Vectors are cut into shards. A shard keeps, for each of ``projections`` random
directions, its vectors' projections in sorted order. A query is projected too;
around its place in every sorted array it opens a window and counts, for each
vector, the arrays whose window holds it. A vector reaching ``threshold``
collisions is verified by its exact inner product (double precision). Virtual
rehashing widens all windows of a query by a constant factor per round, without
other hash tables, until it has verified ``few`` vectors per wanted neighbour and
``beta`` of the shard, one law for shards of every size.

Largest inner product becomes nearness by one more coordinate, sqrt(M^2 - |x|^2)
with M the largest norm (0 for queries): distances then order like products.

The index holds every row of its shard. Shards and blocks of queries, both bounded,
meet once each; a query's candidates per shard are merged per query. The products of
a block come from one matrix product, of which only verified vectors are looked at;
those that can be among the nearest are summed anew, term by term in one order, so
equal vectors tie wherever they stand.

Every shard is searched for every query, so the work grows with their product.

Vectors that are null, empty or zero, or hold a null or a non-finite component take no
part, nor do rows with a null id. Vectors of several lengths are searched among those of
their own. Each row is a candidate and, if its id says so, a query by itself: rows that
share an id and repeated rows find each other. Ties go to the smaller id. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stable

PROJECTIONS, THRESHOLD, BETA, FEW, WIDEN, SEED = 128, 0.5, 0.2, 4, 1.3, 41
SHARD_ROWS, QUERY_ROWS = 8192, 1024


def clean_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, vec_id, v, norm2, d) of the vectors that take part; d is their length."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(F.coalesce(ok, F.lit(False)))
    rows = rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).where("norm2 > 0")
    return stable(rows.withColumn("d", F.size("v"))).withColumn("row", F.monotonically_increasing_id())


def _packed(rows: DataFrame, blocks: str, name: str) -> DataFrame:
    """Blocks of vectors of one length as (d, name, ids, rows, matrix) rows, dealt by a hash of the row;
    the column ``blocks`` says over how many."""
    def pack(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("row").to_numpy(), table.column("vec_id").to_numpy()))
        ids, row = table.column("vec_id").to_numpy()[order], table.column("row").to_numpy()[order]
        matrix = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order]
        return pa.table({"d": table.column("d").slice(0, 1), name: table.column("block").slice(0, 1),
                         "ids": [ids.astype("<i8").tobytes()], "rows": [row.astype("<i8").tobytes()],
                         "matrix": [matrix.astype("<f8").tobytes()]})

    dealt = rows.select("row", "vec_id", "v", "d", F.pmod(F.xxhash64("row"), F.col(blocks)).alias("block"))
    return stable(dealt.groupBy("d", "block").applyInArrow(pack, f"d int, {name} long, ids binary, rows binary, matrix binary"))


class Index:
    """Sorted projections of one shard; the arrays stand one behind the other, ``gap`` apart."""

    def __init__(self, points: np.ndarray, directions: np.ndarray):
        p = points @ directions
        self.n, self.m = p.shape
        self.gap = 4.0 * float(np.abs(p).max()) + 1.0
        order = np.argsort(p, axis=0, kind="stable")
        self.shift = self.gap * np.arange(self.m)
        self.places = (np.take_along_axis(p, order, axis=0) + self.shift).T.ravel()
        self.order = order.T.astype(np.intp).ravel()
        self.base = self.n * np.arange(self.m)

    def candidates(self, q: np.ndarray, threshold: int, wanted: int, width: float, widen: float) -> tuple[np.ndarray, float]:
        """Vectors whose collisions reach the threshold, once ``wanted`` of them do, and the width then."""
        counts = np.zeros(self.n, np.int64)
        at = q + self.shift
        lo = np.clip(np.searchsorted(self.places, at), self.base, self.base + self.n)
        hi = lo
        while True:
            a = np.maximum(np.searchsorted(self.places, at - width), self.base)
            b = np.minimum(np.searchsorted(self.places, at + width), self.base + self.n)
            a, b = np.minimum(a, lo), np.maximum(b, hi)
            # only what the windows have grown by
            ends = ((a, b),) if (lo == hi).all() else ((a, lo), (hi, b))
            grown = [self.order[i:j] for x, y in ends for i, j in zip(x.tolist(), y.tolist(), strict=True)]
            counts += np.bincount(np.concatenate(grown), minlength=self.n)
            lo, hi = a, b
            found = np.flatnonzero(counts >= threshold)
            if len(found) >= wanted or int((hi - lo).min()) == self.n:
                return found, width
            width *= widen


def _best(ids: np.ndarray, matrix: np.ndarray, q: np.ndarray, got: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the ``k`` largest products among ``got``; ``near`` are these products up to rounding."""
    if len(got) > k:
        least = np.partition(near, len(near) - k)[len(near) - k]
        got = got[near >= least - 1e-9 * np.abs(near).max()]
    score = (matrix[got] * q).sum(axis=1)
    order = np.lexsort((ids[got], -score))[:k]
    return got[order], score[order]


def nearest(table: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            projections: int = PROJECTIONS, threshold: float = THRESHOLD, beta: float = BETA, few: int = FEW,
            widen: float = WIDEN, seed: int = SEED, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's nearest vectors; queries
    are the rows whose id is divisible by ``every``."""
    rows = clean_vectors(table, id_col, vec_col)
    asks = F.col("vec_id") % every == 0
    # one row per vector length
    plan = F.broadcast(stable(rows.groupBy("d").agg(
        F.max("norm2").alias("most"), F.ceil(F.count("*") / shard_rows).alias("n_shards"),
        F.ceil(F.greatest(F.count(F.when(asks, 1)), F.lit(1)) / query_rows).alias("n_parts"))))
    placed = rows.join(plan, "d")
    shards = _packed(placed, "n_shards", "shard").join(plan, "d").select(
        "*", F.explode(F.expr("sequence(0L, n_parts - 1)")).alias("part")).drop("n_shards", "n_parts")
    queries = _packed(placed.where(asks), "n_parts", "part").join(plan, "d").select(
        "d", "part", F.explode(F.expr("sequence(0L, n_shards - 1)")).alias("shard"), F.col("ids").alias("q_ids"),
        F.col("rows").alias("q_rows"), F.col("matrix").alias("q_matrix"))
    pairs = shards.join(queries, ["d", "shard", "part"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, most = batch.column("d")[i].as_py(), batch.column("most")[i].as_py()
                ids, row, q_ids, q_row = (np.frombuffer(batch.column(c)[i].as_py(), "<i8") for c in ("ids", "rows", "q_ids", "q_rows"))
                matrix, q_matrix = (np.frombuffer(batch.column(c)[i].as_py(), "<f8").reshape(-1, dim) for c in ("matrix", "q_matrix"))
                directions = np.random.default_rng(seed).standard_normal((dim + 1, projections))
                directions /= np.linalg.norm(directions, axis=0)
                extra = np.sqrt(np.maximum(0.0, most - (matrix ** 2).sum(axis=1)))
                index = Index(np.column_stack([matrix, extra]), directions)
                # queries are scaled to norm M, which changes no order
                scaled = q_matrix * np.sqrt(most / (q_matrix ** 2).sum(axis=1))[:, None]
                places = scaled @ directions[:dim]
                wanted = min(len(ids), few * k + 1 + round(beta * len(ids)))
                near, least = round(threshold * projections), 0.4 * np.sqrt(most / (dim + 1))
                width, out = least, []
                for lo in range(0, len(q_ids), 256):
                    product = q_matrix[lo:lo + 256] @ matrix.T
                    for j in range(lo, min(lo + 256, len(q_ids))):
                        # the first window is a step below that of the query before
                        got, width = index.candidates(places[j], near, wanted, max(least, width / widen), widen)
                        got = got[row[got] != q_row[j]]
                        best, score = _best(ids, matrix, q_matrix[j], got, product[j - lo, got], k)
                        out.append((np.full(len(best), q_ids[j]), np.full(len(best), q_row[j]), ids[best], row[best], score))
                names = ["query_id", "query_row", "vec_id", "row", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(5)], names=names)

    found = pairs.select("d", "most", "ids", "rows", "matrix", "q_ids", "q_rows", "q_matrix").mapInArrow(
        search, "query_id long, query_row long, vec_id long, row long, score double")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score")
