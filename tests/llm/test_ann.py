import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from loanlake.llm.ann import SHARD_ROWS, nearest
from loanlake.llm.queries import op3_collision_counting_ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    """Each query row's nearest rows, by its id; rows that share an id one behind the other."""
    rows = sorted(rows, key=lambda r: r[0])
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for own, (i, v) in enumerate(zip(ids.tolist(), m)):
        if i % every == 0:
            score = (m * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if j != own][:k]
            out.setdefault(i, []).extend((int(ids[j]), float(score[j])) for j in order)
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    got = {}
    for r in nearest(table, shard_rows=700).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    assert got.keys() == want.keys()
    hits = 0
    for q, rows in got.items():
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        hits += len({r["vec_id"] for r in rows} & {i for i, _ in want[q]})
    assert hits >= 0.95 * 20 * len(want)


def test_small_and_odd_tables_are_exact(spark, clash):
    r = np.random.default_rng(1)
    good = [(i, [float(x) for x in np.float32(r.standard_normal(6) * (1 + i % 5))]) for i in range(41)]
    good += [(60, good[7][1]), (61, good[7][1]), (-20, good[3][1])]
    bad = [(100, None), (120, [0.0] * 6), (140, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (160, [float("nan")] * 6),
           (180, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (220, [])]
    good += good[:3] + [(20, good[5][1])]  # repeated rows, and an id used again
    short = [(i, [float(i), 2.0 - i]) for i in (200, 201, 202, 220)]  # vectors of another length
    rows = [(i, v, None) for i, v in good + bad + short]
    got = {}
    for x in nearest(clash(spark.createDataFrame(rows, SCHEMA))).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    want = brute(good) | brute(short)
    assert got.keys() == want.keys()
    for q, found in want.items():
        own = 20 if len(found) % 20 == 0 else len(found)
        ranked = sorted((n % own + 1, i, s) for n, (i, s) in enumerate(found))
        assert [x[:2] for x in sorted(got[q])] == [x[:2] for x in ranked]
        assert np.allclose([x[2] for x in sorted(got[q])], [x[2] for x in ranked], rtol=1e-12)
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0], 1), (21, [2.0, 1.0], 1)], SCHEMA)
    assert [tuple(x) for x in nearest(one).collect()] == [(20, 1, 21, 4.0)]


def test_equal_vectors_tie_by_id(spark):
    r = np.random.default_rng(3)
    same = [float(x) for x in np.float32(r.standard_normal(33))]
    rows = [(i, same) for i in range(1000, 3000)] + [(i, [float(x) for x in np.float32(0.1 * r.standard_normal(33))]) for i in range(500)]
    rows += [(20000, [2 * x for x in same])]
    got = {}
    for x in nearest(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), shard_rows=600, query_rows=40).collect():
        got.setdefault(x["query_id"], {})[x["rank"]] = x["vec_id"]
    for q in (1000, 1500, 2980):
        want = [20000] + [i for i in range(1000, 1030) if i != q][:19]
        assert [got[q][k] for k in range(1, 21)] == want


def _recall(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet")
    ids, m = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), np.float32).astype(np.float64)
    got = {}
    for r in op3_collision_counting_ann(spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    asked = np.flatnonzero(ids % 20 == 0)
    assert got.keys() == set(ids[asked].tolist())
    hits = 0
    for i in asked:
        score = m @ m[i]
        score[i] = -np.inf
        hits += len(got[int(ids[i])] & set(ids[np.argsort(-score)[:20]].tolist()))
    return hits / (20 * len(asked))


def test_recall_with_the_query_s_own_defaults(spark, tmp_path):
    source = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    small = _recall(spark, "/root/testdata/sf0.1")
    print("recall on sf0.1:", small)
    assert small >= 0.9
    # several full default shards of vectors with the table's label means and spread
    m, label = np.array(source["embedding"].to_pylist()), source["label"].to_numpy()
    r, names = np.random.default_rng(7), np.unique(label)
    mean, spread = (np.stack([f(m[label == x], axis=0) for x in names]) for f in (np.mean, np.std))
    n = 3 * SHARD_ROWS
    pick = r.integers(0, len(names), n)
    made = (mean[pick] + spread[pick] * r.standard_normal((n, m.shape[1]))).astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(made), pa.list_(pa.float32())),
                             "label": names[pick]}), str(tmp_path / "embeddings.parquet"))
    recall = _recall(spark, str(tmp_path))
    print("recall on three shards:", recall)
    assert recall >= 0.9
