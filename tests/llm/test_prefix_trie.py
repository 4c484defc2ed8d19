import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loanlake.llm.prefix_trie import WIDTH, Skeleton, ordered_turns, prefix_trie, share_heads, shared_turns

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n=120):
    r = random.Random(seed)
    said = [(r.choice(["user", "assistant", None]), t) for t in ["a", "é", "", None, "hello", "the same", "b" * 9]]
    rows = []
    for c in range(n):
        for turn in range(r.choice([0, 1, 3, 4, 9, 14])):
            rows.append((c, turn if r.random() < .95 else None, *r.choice(said[:2 if seed % 2 else 7])))
    hot = [(t, *r.choice(said)) for t in range(12)]
    rows += [(1000 + 5 * i, *x) for i in range(60) for x in hot]  # a group of equal conversations
    rows += [(5000, t, "user", r.choice("xy")) for t in range(300)]  # a long one
    rows += [(5001, t, "user", "x") for t in range(40)] + [(7003, 0, "user", "gone")] + [(7014, 0, "a", "b")] * 3
    return rows + [(None, 0, "user", "no id"), (None, None, None, None), (8000, None, None, None)]


def nodes(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("x")).withColumn("path", F.lit(1)).repartition(5)
    return prefix_trie(*share_heads(ordered_turns(docs)), **options)


@pytest.mark.parametrize("seed,options", [(1, {"partitions": 7}), (2, {"partitions": 23, "piece": 2}),
                                          (3, {"partitions": 6, "segment": 50, "piece": 3}), (4, {"partitions": 3, "segment": 120}), (5, {})])
def test_matches_brute_force(spark, seed, options):
    rows = conversations(seed)
    got = nodes(spark, rows, **options)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == brute(rebuilt(rows))


def test_turn_digests_name_the_last_turn(spark):
    rows = conversations(6, 30)
    got = nodes(spark, rows, partitions=4).collect()
    want = {hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()[:WIDTH]
            for ts in rebuilt(rows).values() for r, t in ts}
    assert {bytes(r["turn_digest"]) for r in got if r["depth"]} == want
    assert [r["turn_digest"] for r in got if not r["depth"]] == [None]


def test_no_conversations(spark):
    assert nodes(spark, [(None, 1, "user", "x")]).count() == 0
    assert nodes(spark, []).count() == 0


def test_skeleton_names_are_the_trie_of_the_splitters():
    r = random.Random(1)
    key = lambda word: b"".join(bytes([ord(x)]) * WIDTH for x in word)
    for _ in range(50):
        words = ["".join(r.choice("abc") for _ in range(r.randrange(6))) for _ in range(8)]
        s = Skeleton([key(w) for w in words])
        prefixes = {w[:d] for w in words for d in range(len(w) + 1)} | {""}
        names = {}
        for w in words:
            at, depth = s.deepest(key(w))
            assert depth == len(w)
            for d in range(depth + 1):
                assert names.setdefault(w[:d], s.name(at, d)) == s.name(at, d)
                assert s.parent(s.name(at, d)) == (s.name(at, d - 1) if d else None)
        assert len(set(names.values())) == len(names) == len(prefixes - {""}) + ("" in names)
        assert sorted(names, key=names.get) == sorted(names)
        for _ in range(20):
            w = "".join(r.choice("abcd") for _ in range(6))
            assert s.deepest(key(w))[1] == max(d for d in range(7) if w[:d] in prefixes)
        assert shared_turns(key("abca"), key("abcb")) == 3
