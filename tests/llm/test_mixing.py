import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from loanlake.llm.mixing import mix_blocks, mix_documents, mix_report, split_quotas, targets


def n_words(t):
    return len([w for w in re.split("[ \t\n\x0b\x0c\r]+", t or "") if w])


def test_targets_cap_and_reshare():
    assert targets([100, 100], [4, 1], 3) == [160, 40]
    got = targets([10, 1000, 500], [5, 2, 1], 3)
    assert got[0] == 30 and abs(sum(got) - 1510) < 1e-9 and abs(got[1] - 2 * got[2]) < 1e-9
    assert targets([0, 0], [5, 2], 3) == [0, 0]


def test_splitting_tree_keeps_exact_quotas():
    for quotas in ([1000, 37, 0, 5], [3], [0, 0], [10 ** 7, 1]):
        got = split_quotas(quotas, 7, 5)
        assert got.sum(axis=0).tolist() == quotas
        assert np.ptp(got.sum(axis=1)) <= 1
        assert (got == split_quotas(quotas, 7, 5)).all()


def test_report_matches_brute_force(odd_docs, odd_rows, no_docs, clash):
    rows = mix_report(clash(odd_docs).drop("size")).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d, n_words(t)) for d, t, *_ in odd_rows)
    sizes = defaultdict(int)
    for _, t, _, s, _ in odd_rows:
        sizes[s] += n_words(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    goal = dict(zip(order, targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 3)))
    taken = defaultdict(int)
    by_id = {d: s for d, _, _, s, _ in odd_rows if d not in (5, None)}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["shard"] is None) == (not r["taken"])
        if r["doc_id"] in by_id:
            s = by_id[r["doc_id"]]
            assert r["source_size"] == sizes[s] and abs(r["target"] - goal[s]) < 1e-6
        taken[r["target"]] += r["taken"]
    assert all(abs(n - t) <= 40 for t, n in taken.items())
    again = mix_report(odd_docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert mix_report(no_docs).count() == 0


def test_hot_group_of_equal_rows(spark, odd_docs):
    same = spark.createDataFrame([(1, "one two three four five six seven", "en", "a", 3)] * 500
                                 + [(None, "x " * 50, None, None, 3)] * 3, odd_docs.schema).repartition(8)
    rows = mix_report(same).collect()
    taken = [r["taken"] for r in rows if r["doc_id"] == 1]
    assert len(rows) == 503 and max(taken) - min(taken) <= 1


def test_short_equal_rows_meet_their_target(spark, odd_docs):
    rows = [(1, "one", "en", "a", 3)] * 5000 + [(i, "ten words " * 5, "en", "b", 100) for i in range(10, 510)]
    docs = spark.createDataFrame(rows, odd_docs.schema).repartition(8)
    report = mix_report(docs, weights=(2.0, 5.0)).collect()
    taken, goal = defaultdict(int), {}
    for r in report:
        source = "a" if r["doc_id"] == 1 else "b"
        taken[source] += r["taken"]
        goal[source] = r["target"]
    assert all(abs(taken[s] - goal[s]) <= 64 for s in goal) and 0 < taken["a"] < 5000
    mixed = Counter(r["doc_id"] == 1 for r in mix_documents(docs, weights=(2.0, 5.0)).collect())
    assert mixed[True] == taken["a"]


def test_columns_with_the_operators_names_come_back(odd_docs):
    clash = odd_docs
    for c in ("_size", "_turn", "_rounds", "_copy", "size", "shard", "Taken"):
        clash = clash.withColumn(c, F.lit("mine"))
    out = mix_documents(clash)
    assert out.columns == clash.columns
    assert all(r["_size"] == r["_turn"] == r["Taken"] == "mine" for r in out.collect()) and out.count() == mix_documents(odd_docs).count()


def test_documents_of_the_mix(odd_docs, odd_rows, no_docs):
    plan = {}
    for r in mix_report(odd_docs).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"]
    out = mix_documents(odd_docs)
    assert out.columns == odd_docs.columns
    got, texts = defaultdict(int), defaultdict(set)
    for d, t, *_ in odd_rows:
        texts[d].add(t or "")
    for r in out.collect():
        got[r["doc_id"]] += n_words(r["text"])
        assert any(t.startswith(r["text"]) for t in texts[r["doc_id"]])
    assert got == {k: v for k, v in plan.items() if v}
    assert mix_documents(no_docs).count() == 0


def test_blocks_meet_the_shards_quotas(spark, odd_docs):
    long = [(1000 + i, f"w{i} " * n, "en", s, 1) for i, (s, n) in enumerate([("big", 20_000), ("z", 700), ("z", 90)])]
    docs = odd_docs.unionByName(spark.createDataFrame(long, odd_docs.schema)).cache()
    words, shards, rounds, taken = defaultdict(int), defaultdict(set), defaultdict(set), defaultdict(int)
    for r in mix_blocks(docs).collect():
        words[r["source"], r["block"]] += r["words"]
        shards[r["source"], r["block"]].add(r["shard"])
        taken[r["doc_id"]] += r["words"]
        if r["doc_id"] == 1000:
            rounds[r["round"]].add(r["shard"])
    assert all(len(x) == 1 for x in shards.values()) and max(words.values()) == 64
    names = sorted({s for s, _ in shards}, key=lambda s: (s is None, s))
    quotas = [sum(s == n for s, _ in shards) for n in names]
    assert all({b for s, b in shards if s == n} == set(range(q)) for n, q in zip(names, quotas))
    got = np.zeros((8, len(names)), int)
    for (s, _), at in shards.items():
        got[at.pop(), names.index(s)] += 1
    assert (got == split_quotas(quotas, 8, 17)).all() and np.ptp(got.sum(axis=1)) <= 1
    assert all(len(x) == 8 for x in rounds.values())
    report = mix_report(docs).collect()
    once = [r for r in report if r["doc_id"] not in (None, 5, 300)]
    for r in once:
        assert (r["shard"] is None) == (r["taken"] == 0)
        dealt = dict(x.split(":") for x in r["dealt"].split())
        assert sum(map(int, dealt.values())) == taken[r["doc_id"]]
    assert all(abs(r["taken"] - taken[r["doc_id"]]) < 1 for r in once if r["doc_id"] >= 1000)


def test_rounds_go_to_several_shards_in_shuffled_order(spark, odd_docs):
    docs = spark.createDataFrame([(i, f"w{i} " * 150, "en", "a" if i < 10 else "b", 1) for i in range(400)], odd_docs.schema)
    ids = [r["doc_id"] for r in mix_documents(docs).collect()]
    first = [i for i in ids if i < 10]
    assert Counter(first) == Counter({i: 3 for i in range(10)})
    places = [[k for k, x in enumerate(ids) if x == i] for i in range(10)]
    assert sum(max(p) - min(p) > 50 for p in places) >= 5
