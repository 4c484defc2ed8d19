import random
import zlib
from collections import Counter, defaultdict

from loanlake.llm.langid import UNKNOWN, _grams, _letters, identify, language_id, learn_profiles


def plain_grams(text):
    """The same n-grams by strings."""
    out = Counter()
    flat = "".join(c if c.isalpha() else " " for c in text.lower())
    for w in flat.split():
        out.update(w)
        p = f" {w} "
        out.update(p[i:i + 2] for i in range(len(p) - 1))
        out.update(p[i:i + 3] for i in range(len(p) - 2))
    return out


def test_grams_match_plain_strings():
    texts = ["The cat, the hat.", "", "123 !!", "été über Übung", "a b", "x" * 50]
    owner, _, n = _grams(texts, _letters())
    got = defaultdict(list)
    for o, k in zip(owner.tolist(), n.tolist()):
        got[o].append(k)
    for i, t in enumerate(texts):
        assert sorted(got[i]) == sorted(plain_grams(t).values())


def test_held_out_accuracy_and_undetermined(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id(docs).select("doc_id", "lang", "held_out", "lang_pred", "score", "text").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and any(c.isalpha() for c in r["text"] or "")]
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1


def test_odd_rows(odd_docs, odd_rows, no_docs, clash):
    out = language_id(clash(odd_docs))
    assert set(clash(odd_docs).columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in ("en", "fr")) == lettered and (r["lang_pred"] == UNKNOWN) == (not lettered)
    assert language_id(no_docs).count() == 0
    assert {r["lang_pred"] for r in identify(odd_docs, {}).collect()} == {UNKNOWN}


def ranked(grams, top):
    """By falling count; of one count the shorter first, then by code points, a word end before all letters."""
    order = lambda g: (-grams[g], len(g), [0 if c == " " else ord(c) for c in g])
    return sorted(grams, key=order)[:top]


def test_matches_plain_strings_from_profiles_to_scores(spark, odd_docs, odd_rows):
    r = random.Random(2)
    han = [chr(0x4E00 + i) for i in range(1500)]  # more letters than ten bits hold
    script = lambda lo: "".join(r.choice(han[lo:lo + 900]) + r.choice(["", "", " "]) for _ in range(400))
    rows = odd_rows + [(900 + i, script(600 * (i % 2)), ["zh", "ja"][i % 2], "a", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, odd_docs.schema).repartition(3)
    top, totals = 60, defaultdict(Counter)
    for _, t, lang, *_ in rows:
        if t is not None and lang is not None:
            totals[lang].update(plain_grams(t))
    profiles = {lang: ranked(grams, top) for lang, grams in totals.items()}
    want = {}
    for d, t, *_ in rows:
        mine = ranked(plain_grams(t or ""), top)
        if mine:
            dist = {lang: sum(min(abs(i - p.index(c)), top) if c in p else top for i, c in enumerate(mine)) / len(mine)
                    for lang, p in profiles.items()}
            best = min(sorted(dist), key=dist.get)
            want[d, t] = (best, round(1 - dist[best] / top, 9))
    got = identify(docs, learn_profiles(docs, top=top, per_lang=10 ** 9), top=top).collect()
    assert len(got) == len(rows) and {b for b, _ in want.values()} >= {"zh", "ja", "en", "fr"}
    for x in got:
        assert (x["lang_pred"], round(x["score"], 9)) == want.get((x["doc_id"], x["text"]), (UNKNOWN, 0.0))


def test_a_code_stands_for_one_gram():
    texts = ["".join(chr(0x4E00 + i) + chr(0xAC00 + i) for i in range(0, 3000, 7)), "".join(chr(c) for c in range(0x10400, 0x10440))]
    owner, code, n = _grams(texts, _letters())
    for i, t in enumerate(texts):
        assert len(set(code[owner == i].tolist())) == len(plain_grams(t)) == int((owner == i).sum())


def test_emoji_are_not_letters(spark, odd_docs):
    texts = ["😀😀 🚀", "the 😀cat", "𝒜𝓁𝒻 𐐷"]
    owner, _, n = _grams(texts, _letters())
    for i, t in enumerate(texts):
        assert sorted(n[owner == i].tolist()) == sorted(plain_grams(t).values())
    more = odd_docs.unionByName(spark.createDataFrame([(900, texts[0], "en", "a", 4)], odd_docs.schema))
    got = language_id(more).where("doc_id = 900").first()
    assert (got["lang_pred"], got["score"]) == (UNKNOWN, 0.0)
