import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from loanlake.llm.suffix_dedup import remove_repeats, repeated_windows, sent_strings, suffix_ranks


def brute(rows, need):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + need] for _, b in raw for i in range(len(b) - need + 1))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - need + 1):
            if seen[b[i:i + need]] > 1:
                gone[i:i + need] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(seed):
    r = random.Random(seed)
    rand = lambda n, letters="abcdé ": "".join(r.choice(letters) for _ in range(n))
    passage, run = rand(90), "x" * 75
    rows = [(i, rand(r.randrange(0, 200)) + (passage[r.randrange(0, 20):] if r.random() < 0.5 else "") + rand(40)
             + (run if r.random() < 0.3 else "")) for i in range(60)]
    rows += [(100, rows[0][1]), (101, None), (102, ""), (None, rows[3][1]), rows[4], (103, "ab" * 90), (104, rand(2000, "ab"))]
    return rows


@pytest.mark.parametrize("seed,need,gram", [(1, 40, 12), (2, 25, 25), (3, 60, 20)])
def test_matches_brute_force(spark, seed, need, gram):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeats(docs, need=need, gram=gram, block_bytes=1500).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, need)


def test_production_parameters_and_real_outputs(spark, odd_docs, odd_rows, no_docs, clash):
    got = remove_repeats(clash(odd_docs), with_text=True).collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == brute([r[:2] for r in odd_rows], 200)
    whole = {}
    for d, t, *_ in odd_rows:
        whole.setdefault(d, set()).add((t or "").encode())
    for r in got:
        assert any(b"".join(b[e:s] for e, s in zip([0] + [x["end"] for x in r["spans"]], [x["start"] for x in r["spans"]] + [len(b)]))
                   == bytes(r["kept"]) for b in whole[r["doc_id"]] if len(b) == r["n_bytes"])
    assert remove_repeats(no_docs).count() == 0


def test_suffix_ranks_order_all_suffixes():
    r = np.random.default_rng(5)
    for n in [1, 2, 3, 4, 5, 7, 10, 33, 200]:
        for letters in (2, 4):
            s = r.integers(1, letters + 1, n)
            rank = suffix_ranks(s, 1, 10 ** 9)
            want = sorted(range(n), key=lambda i: s[i:].tolist())
            assert np.argsort(rank, kind="stable").tolist() == want


def test_repeated_windows_of_strings():
    r = np.random.default_rng(6)
    for need in (3, 8, 20):
        strings = list({bytes(r.integers(97, 99, r.integers(need, need + 25)).astype(np.uint8)) for _ in range(30)})
        seen = Counter(s[i:i + need] for s in strings for i in range(len(s) - need + 1))
        got = repeated_windows([np.frombuffer(s, np.uint8) for s in strings], need)
        for s, g in zip(strings, got):
            assert g.tolist() == [seen[s[i:i + need]] > 1 for i in range(len(s) - need + 1)]


def test_a_hot_anchor_is_split(spark):
    r = random.Random(9)
    own = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    short, long = own(45), own(150)
    rows = [(i, own(70) + (short if i % 2 else long) + own(70)) for i in range(400)]
    # the same words of their own around the passage, in pairs
    rows += [(1000 + i, rows[i % 40][1][20:-25] + own(9)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def largest(bucket_bytes):
        _, sent, _ = sent_strings(docs, 60, 20, "doc_id", "text", 9000, bucket_bytes)
        out = Counter()
        for x in sent.select("bucket", "lens").collect():
            out[x["bucket"]] += int(np.frombuffer(x["lens"], "<i4").sum())
        return max(out.values())

    assert largest(10 ** 9) > 10_000 and largest(1600) < 5_000, (largest(10 ** 9), largest(1600))
    got = remove_repeats(docs, need=60, gram=20, block_bytes=9000, bucket_bytes=1600).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 60)
