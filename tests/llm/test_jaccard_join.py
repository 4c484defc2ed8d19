import random
import re
from itertools import combinations

import numpy as np
import pytest

from loanlake.llm.components import components
from loanlake.llm.jaccard_join import jaccard_components, keep_one_each, shingle_sets, trie_links


def shingles(text):
    low = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", low) if x]
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(zip(w, w[1:], w[2:], w[3:], w[4:]))


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def brute(rows):
    """Least id reachable; rows of one id are one node, rows without an id link with nothing."""
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in combinations([x for x in sets if x[0] is not None], 2):
        if a != b and linked(s, t):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted(((d, len(s), find(d) if s and d is not None else d) for d, s in sets), key=repr)


def near_copies(r, families=12, most=9, vocabulary=400):
    words = [f"W{i}" if i % 3 else f"w{i}é" for i in range(vocabulary)]
    rows, n = [], 0
    for _ in range(families):
        base = [r.choice(words) for _ in range(r.randrange(1, 90))]
        for _ in range(r.randrange(1, most)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                copy[r.randrange(len(copy))] = r.choice(words)
            if r.random() < 0.3:
                copy = copy[:r.randrange(1, len(copy) + 1)]
            rows.append((n * 7 % 1009, r.choice([" ", "\n", "  "]).join(copy)))
            n += 1
    return rows


@pytest.mark.parametrize("seed,chunk", [(1, 50_000), (2, 60), (3, 150)])
def test_components_match_brute_force(spark, seed, chunk):
    r = random.Random(seed)
    rows = near_copies(r) + [(5000, None), (5001, ""), (5002, "one two"), (5003, "One  TWO"), (None, "one two"), (5004, " \n")]
    rows += [rows[0], (5005, rows[1][1]), (rows[2][0], rows[9][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_components(docs, block_bytes=2000, chunk_shingles=chunk).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_one_of_each_group_stays(spark, odd_docs, odd_rows, no_docs):
    got = keep_one_each(odd_docs).collect()
    component = {d: c for d, n, c in brute([r[:2] for r in odd_rows]) if n and d is not None}
    wordless = [r for r in odd_rows if not shingles(r[1]) or r[0] is None]
    kept = [tuple(r) for r in got if shingles(r["text"]) and r["doc_id"] is not None]
    assert sorted(d for d, *_ in kept) == sorted(set(component.values()))
    assert set(kept) <= set(odd_rows)
    assert sorted((tuple(r) for r in got if tuple(r) not in kept), key=repr) == sorted(wordless, key=repr)
    assert keep_one_each(no_docs).count() == 0


def test_odd_rows(odd_docs, odd_rows, no_docs, clash):
    got = jaccard_components(clash(odd_docs)).collect()
    assert sorted(map(tuple, got), key=repr) == brute([r[:2] for r in odd_rows])
    assert jaccard_components(no_docs).count() == 0


def test_trie_finds_all_components():
    r = np.random.default_rng(4)
    for trial in range(40):
        base = [r.choice(60, r.integers(3, 30), replace=False) for _ in range(4)]
        sets = []
        for _ in range(25):
            s = set(base[r.integers(4)].tolist())
            for _ in range(r.integers(0, 5)):
                s.discard(int(r.integers(60)))
                s.add(int(r.integers(60)))
            sets.append(np.array(sorted(s), np.uint64))
        sizes = np.array([len(s) for s in sets]) + r.integers(0, 2, len(sets))
        want = {i: i for i in range(len(sets))}

        def find(m, x):
            while m[x] != x:
                x = m[x]
            return x

        for i, j in combinations(range(len(sets)), 2):
            if 7 * len(set(sets[i].tolist()) & set(sets[j].tolist())) >= 3 * (sizes[i] + sizes[j]):
                want[find(want, i)] = find(want, j)
        got = {i: i for i in range(len(sets))}
        for i, j in trie_links(sizes, sets):
            got[find(got, i)] = find(got, j)
        groups = lambda m: sorted(sorted(k for k in m if find(m, k) == g) for g in {find(m, k) for k in m})
        assert groups(got) == groups(want)


def test_shingles_are_whole_and_distinct():
    texts = ["a b c d e f", "A  B c D e F a b c d e", "x", "", "x y z", "é É"]
    raw = [t.encode() for t in texts]
    got = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    assert set(got[0].tolist()) <= set(got[1].tolist())


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(200, 300)] + [(7, 7), (60, 59)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, **{i: 100 for i in range(200, 300)}, 60: 59, 59: 59}
