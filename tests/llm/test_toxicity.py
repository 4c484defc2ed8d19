import zlib

import numpy as np
import pytest

from loanlake.llm.toxicity import STRIDE, WINDOW, Network, _log_odds, score_toxicity, windows, words


def test_gradients_match_differences():
    net, r = Network(1), np.random.default_rng(2)
    for k in net.dense:
        net.dense[k] = net.dense[k].astype(np.float64) + 0.1 * r.standard_normal(net.dense[k].shape)
    x = r.standard_normal((17, 8))
    starts, lens = np.array([0, 5, 9]), np.array([5, 4, 8])
    slope = np.array([0.3, -0.7, 0.2])
    _, tape, pooled, total, kept = net.run(x, starts, lens, keep=True)
    grad, d_x = net.gradients(slope, tape, pooled, total, kept)
    loss = lambda: float(net.run(x, starts, lens).astype(np.float64) @ slope)
    for a, g in [(net.dense[k], grad[k]) for k in net.dense] + [(x, d_x)]:
        for i in r.choice(a.size, min(6, a.size), replace=False):
            old = a.flat[i]
            a.flat[i] = old + 1e-3
            up = loss()
            a.flat[i] = old - 1e-3
            down = loss()
            a.flat[i] = old
            assert g.flat[i] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3)


def test_windows_overlap_and_cover():
    owner, at, lens = windows(np.array([0, 0, 10, 74, 300]))
    assert owner.tolist()[:3] == [0, 1, 2] and lens.tolist()[:3] == [0, 10, 64] and lens.max() <= WINDOW
    last = [(a, n) for o, a, n in zip(owner, at, lens) if o == 3]
    assert {i for a, n in last for i in range(a, a + n)} == set(range(74, 300))
    assert all(b[0] - a[0] == STRIDE for a, b in zip(last, last[1:]))


def test_words_and_log_odds():
    text, starts, ends, first = words(np.frombuffer("Ab, CÉ1\n".encode() + b"x", np.uint8), np.array([0, 9, 10]))
    assert [text[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["ab", "cÉ1", "x"] and first.tolist() == [0, 2, 3]
    odds = _log_odds([np.array([1, 1]), np.array([2]), np.array([2]), np.array([1])], np.array([1.0, 0, 0, 1]))
    assert odds[1] > 0 > odds[2] and odds[3] == 0


def test_held_out_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    # toxic texts as they are and inside 2,000 and 20,000 clean words, and clean texts of such lengths
    mark = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in mark and r["text"]}
    clean = " ".join(t for d, t in sorted(texts.items()) if not mark[d] and len(t.split()) > 2000).split()[:60_000]
    toxic = [t for d, t in sorted(texts.items()) if mark[d] and 60 <= len(t.split()) <= 400][:20]
    assert len(clean) == 60_000
    planted = [(2_000_000 + n + i, " ".join(clean[i * n:i * n + n]), "en", "a", 1) for n in (2_000, 20_000) for i in range(3)]
    for k, t in enumerate(toxic):
        planted.append((1_000_000 + k, t, "en", "a", 1))
        for j, n in ((1, 2_000), (2, 20_000)):
            body = clean[(k % 3) * n:(k % 3) * n + n]
            planted.append((1_000_000 * (1 + 10 * j) + k, " ".join([*body[:n // 2], t, *body[n // 2:]]), "en", "a", 1))
    n_docs, docs = docs.count(), docs.unionByName(spark.createDataFrame(planted, docs.schema))
    every = score_toxicity(docs, labels).collect()
    rows = {r["doc_id"]: r for r in every}
    assert len(every) == n_docs + len(planted)
    alone = [k for k in range(len(toxic)) if rows[1_000_000 + k]["score"] >= 0.5]
    assert len(alone) > 10
    for n in (11, 21):
        assert sum(rows[1_000_000 * n + k]["score"] > 0.5 for k in alone) >= 0.9 * len(alone)
    assert all(rows[2_000_000 + n + i]["score"] < 0.5 for n in (2_000, 20_000) for i in range(3))
    rows = {d: r for d, r in rows.items() if d < 1_000_000}
    held = [(r["toxic"], rows[r["doc_id"]]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    score = np.array([r["score"] for _, r in held])
    y = np.array([y for y, _ in held])
    rank = np.empty(len(y))
    rank[np.argsort(score)] = np.arange(len(y))
    assert (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum()) > 0.9  # area under the curve
    hit = (score >= 0.5) & (y == 1)
    assert hit.sum() >= 0.5 * y.sum() and hit.sum() >= 0.8 * (score >= 0.5).sum()
    for r in list(rows.values())[:500]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, clash):
    schema = "doc_id long, quality int, toxic int"
    marks = [(d, 1, int("river" in (t or ""))) for d, t, *_ in odd_rows] + [(None, 1, 1), (3, None, None), (9999, 0, 1)]
    rows = score_toxicity(clash(odd_docs), spark.createDataFrame(marks, schema)).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    for label in ([], [(1, 0, 1)], [(1, 0, 0), (2, 0, None)]):
        rows = score_toxicity(odd_docs, spark.createDataFrame(label, schema)).collect()
        assert {r["score"] for r in rows} == {1.0 if label == [(1, 0, 1)] else 0.0}
    assert score_toxicity(no_docs, spark.createDataFrame(marks, schema)).count() == 0
