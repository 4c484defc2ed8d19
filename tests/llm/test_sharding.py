import math
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from loanlake.llm.sharding import layout, place, shard_documents

TREE = layout([1.0] * 24)


def total(node):
    return sum(map(total, node)) if isinstance(node, list) else node


def descend(key, tree):
    """The same law in plain Python: (region, rack, shard) of a long or null id."""
    first = 42 if key is None else xxhash.xxh64(key.to_bytes(8, "little", signed=True), seed=42).intdigest()

    def pick(name, children):
        def draw(i):
            u = xxhash.xxh64(f"{name}.{i}".encode(), seed=first).intdigest() >> 11
            return -math.log((u + 0.5) / 2 ** 53) / total(children[i])
        return min((i for i in range(len(children)) if total(children[i]) > 0), key=draw)

    r = pick("", tree)
    k = pick(f"{r}", tree[r])
    s = pick(f"{r}.{k}", tree[r][k])
    return r, k, sum(len(rack) for i, region in enumerate(tree) for j, rack in enumerate(region) if (i, j) < (r, k)) + s


def test_shards_follow_the_key_law(odd_docs, odd_rows, clash):
    rows = shard_documents(clash(odd_docs), 24).collect()
    assert len(rows) == len(odd_rows)
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by_id, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
        assert (r["region"], r["rack"], r["shard"]) == descend(r["doc_id"], TREE)
        assert r["grown_shard"] == descend(r["doc_id"], layout([1.0] * 25))[2]
    assert all(len(s) == 1 for s in by_id.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_placing_equals_the_plain_tree(spark):
    tree = [[[1.0, 2.0], [0.0], [3.0]], [[0.0, 0.0]], [[0.5], [1.0, 1.0, 4.0]]]
    for r in spark.range(-300, 700).select("id", place(F.col("id"), tree).alias("p")).collect():
        assert tuple(r["p"])[1:] == descend(r["id"], tree)


def test_growth_and_weights_move_only_what_they_must(spark):
    ids = spark.range(20000)
    heavy, gone = layout([1.0] * 5 + [3.0] + [1.0] * 18), layout([1.0] * 5 + [0.0] + [1.0] * 18)
    at = ids.select("id", place(F.col("id"), TREE).alias("a"), place(F.col("id"), layout([1.0] * 25))["shard"].alias("b"),
                    place(F.col("id"), heavy).alias("c"), place(F.col("id"), gone).alias("d")).collect()
    assert all(r["b"] in (r["a"]["shard"], 24) for r in at)
    # shard 5 is in rack 1 of region 0: nothing moves between other regions, nor between other racks of its own
    for r in at:
        assert r["c"]["region"] in (r["a"]["region"], 0) and r["d"]["region"] in (r["a"]["region"], 1)
        if r["c"]["region"] == r["a"]["region"] == 0:
            assert r["c"]["rack"] in (r["a"]["rack"], 1)
            if r["c"]["rack"] == r["a"]["rack"]:
                assert r["c"]["shard"] in (r["a"]["shard"], 5)
        assert r["d"]["shard"] != 5
    sizes = Counter(r["a"]["shard"] for r in at)
    assert len(sizes) == 24 and max(sizes.values()) < 1.25 * 20000 / 24
    assert abs(Counter(r["b"] for r in at)[24] - 800) < 150
    assert abs(Counter(r["c"]["shard"] for r in at)[5] - 20000 * 3 / 26) < 250
    # the descent is by levels: regions and racks are shared alike too
    assert max(Counter((r["a"]["region"], r["a"]["rack"]) for r in at).values()) < 1.1 * 20000 / 6


def test_growth_equals_placing_with_one_more(odd_docs, no_docs):
    for n in (7, 24, 25):
        a = {r["doc_id"]: r["grown_shard"] for r in shard_documents(odd_docs, n).collect()}
        b = {r["doc_id"]: r["shard"] for r in shard_documents(odd_docs, n + 1).collect()}
        assert a == b
    assert shard_documents(no_docs).count() == 0
