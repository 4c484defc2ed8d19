import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from loanlake.llm.automaton_dedup import SuffixAutomaton, match_references, remove_passages, repeated_passages, sent_passages


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def covered(words, need, repeated):
    gone = [False] * len(words)
    for i in range(len(words) - need + 1):
        if repeated(tuple(words[i:i + need])):
            gone[i:i + need] = [True] * need
    return gone


def brute(rows, need):
    every = [(d, words_of(t)) for d, t in rows]
    seen = Counter(tuple(w[i:i + need]) for _, w in every for i in range(len(w) - need + 1))
    out = []
    for d, w in every:
        gone = covered(w, need, lambda x: seen[x] > 1)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(seed):
    r = random.Random(seed)
    rand = lambda n, k=30: "".join(r.choice(["wé", "x", "the", "a", "bb"]) + str(r.randrange(k)) + r.choice([" ", "  ", "\n", "\t\x0b"]) for _ in range(n))
    passage, run = rand(30).split(), "go " * 25
    rows = [(i, rand(r.randrange(0, 60)) + (" ".join(passage[r.randrange(0, 9):]) + " " if r.random() < 0.5 else "") + rand(14)
             + (run if r.random() < 0.3 else "")) for i in range(60)]
    rows += [(100, rows[0][1]), (101, None), (102, ""), (103, " \n\t "), (None, rows[3][1]), rows[4], (104, "a b " * 40),
             (105, rand(1500, 1)), (106, "nb sp　x " * 12), (107, "   lead and trail  ")]
    return rows


@pytest.mark.parametrize("seed,need,grams", [(1, 12, (4, 8, 12)), (2, 9, (9,)), (3, 20, (3, 20)), (4, 5, (2, 5))])
def test_matches_brute_force(spark, seed, need, grams):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_passages(docs, need=need, grams=grams, block_bytes=1500, shard_words=900).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, need)


def test_production_parameters_and_real_outputs(spark, odd_docs, odd_rows, no_docs, clash):
    got = remove_passages(clash(odd_docs), with_text=True).collect()
    assert sorted((tuple(r[:4]) for r in got), key=repr) == brute([r[:2] for r in odd_rows], 35)
    whole = {}
    for d, t, *_ in odd_rows:
        whole.setdefault(d, []).append(words_of(t))
    for r in got:
        gone = {i for s in r["spans"] for i in range(s["start"], s["end"])}
        assert any(" ".join(x for i, x in enumerate(w) if i not in gone).encode() == bytes(r["kept"]) for w in whole[r["doc_id"]] if len(w) == r["n_words"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    assert remove_passages(no_docs).count() == 0


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(map(tuple, remove_passages(docs).collect()), key=repr)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 35) and any(r[2] for r in got)


def test_automaton_counts_and_statistics():
    r = random.Random(3)
    for _ in range(60):
        strings = ["".join(r.choice("ab" if r.random() < .5 else "abc") for _ in range(r.randrange(1, 14))) for _ in range(r.randrange(1, 6))]
        copies = [r.choice([1, 1, 2]) for _ in strings]
        automaton = SuffixAutomaton()
        for s, n in zip(strings, copies):
            automaton.add(s, n)
        ends = Counter()
        for s, n in zip(strings, copies):
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    ends[s[i:j]] += n
        asked = "".join(r.choice("abcd") for _ in range(20))
        for times in (1, 2, 3):
            known = automaton.known_lengths(times)
            for q in [*strings, asked]:
                want = [max(n for n in range(e + 1) if not n or ends[q[e - n:e]] >= times) for e in range(1, len(q) + 1)]
                assert automaton.statistics(q, known) == want


def test_windows_of_passages():
    r = np.random.default_rng(6)
    for need in (3, 8, 15):
        passages = {tuple(r.integers(0, 2, r.integers(need, need + 25)).tolist()): int(r.integers(1, 3)) for _ in range(30)}
        seen = Counter()
        for p, n in passages.items():
            for i in range(len(p) - need + 1):
                seen[p[i:i + need]] += n
        for p, got in zip(passages, repeated_passages(passages, need)):
            assert got.tolist() == [seen[p[i:i + need]] > 1 for i in range(len(p) - need + 1)]


def test_a_hot_anchor_is_split(spark):
    r = random.Random(9)
    own = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    short, long = own(9), own(17)
    rows = [(i, f"{own(20)} {short if i % 2 else long} {own(20)}") for i in range(400)]
    rows += [(1000 + i, " ".join(words_of(rows[i % 40][1])[3:-3]) + " " + own(3)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def largest(shard_words):
        _, sent, _ = sent_passages(docs, 20, (5, 12, 20), "doc_id", "text", 9000, shard_words)
        out = Counter()
        for x in sent.select("shard", "lens").collect():
            out[x["shard"]] += int(np.frombuffer(x["lens"], "<i4").sum())
        return max(out.values())

    assert largest(10 ** 8) > 4_000 and largest(500) < 2_500, (largest(10 ** 8), largest(500))
    got = remove_passages(docs, need=20, grams=(5, 12, 20), block_bytes=9000, shard_words=500).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 20)


def test_references_by_broadcast(spark, odd_docs, odd_rows):
    rows = texts(5)
    references = [(words_of(rows[1][1]) * 3), words_of(rows[2][1]), words_of(odd_rows[0][1])[:40]]
    table = spark.createDataFrame([(" ".join(x),) for x in references] + [(None,), ("",)], "text string")
    need = 7
    known = {tuple(x[i:i + need]) for x in references for i in range(len(x) - need + 1)}
    every = rows + [r[:2] for r in odd_rows]
    docs = spark.createDataFrame(every, "doc_id long, text string")
    got = match_references(docs, table, need=need, shard_words=60).collect()
    want = []
    for d, t in every:
        w = words_of(t)
        gone = covered(w, need, lambda x: x in known)
        want.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    assert sorted((tuple(r[:4]) for r in got), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="more than 50"):
        match_references(docs, table, max_words=50)
