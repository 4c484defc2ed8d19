import math
import re
from collections import Counter, defaultdict

from loanlake.llm.quality import CLASSES, COMMON_WORDS, MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, quality_rules

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def base(text):
    w = words_of(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def histograms(text):
    text = text or ""
    classes = [0] * (len(CLASSES) + 1)
    for ch in text:
        kind = (0 if ch.islower() and ch.isalpha() else 1 if ch in SPACE else 2 if ch.isupper() else 3 if ch in "0123456789"
                else 4 if ch in ".,;:!?'\"()-" else 5 if ch in "#*$%&|<>" else 6)
        classes[kind] += 1
    common = [0] * (len(COMMON_WORDS) + 1)
    for w in words_of(text):
        common[COMMON_WORDS.index(w.lower()) if w.lower() in COMMON_WORDS else -1] += 1
    return classes, common


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    return math.sqrt(max(0, sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0)
                                for a, b in zip(p, q)) / 2))


def test_matches_brute_force(odd_docs, odd_rows, clash):
    refs = defaultdict(lambda: ([0] * (len(CLASSES) + 1), [0] * (len(COMMON_WORDS) + 1)))
    for _, text, lang, *_ in odd_rows:
        for total, part in zip(refs[lang], histograms(text)):
            total[:] = [a + b for a, b in zip(total, part)]
    want = []
    for doc_id, text, lang, *_ in odd_rows:
        b = base(text)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        short = b[0] < 64 or b[1] < 420 or sum(refs[lang][1]) - b[0] < 2500
        near = b[0] > 0 and all(round(distance(h, ref), 4) <= most for h, ref, most in
                                zip(histograms(text), refs[lang], (MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE)))
        want.append((doc_id, *b, failed, not failed and (short or near)))
    got = [tuple(r[:8]) for r in quality_rules(clash(odd_docs), min_chars=420, min_reference=2500).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[-1] for r in got) > 20


def test_guards_act(spark, odd_docs):
    """A text far from its language is judged only if it and its reference are long enough."""
    far = " ".join(f"W{i}%XYZ" for i in range(63))
    alone = " ".join(f"w{i}" for i in range(400))
    tiny = " ".join("a%" for _ in range(60)) + " " + " ".join(f"{chr(97 + i % 26)}{i % 10}%" for i in range(40))
    rows = [(901, far, "en", "a", 1), (902, far + " W99%XYZ W98%XYZ", "en", "a", 1), (903, alone, "xx", "a", 1),
            (904, tiny, "en", "a", 1)]
    got = {r["doc_id"]: r for r in quality_rules(odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema))).where(
        "doc_id between 901 and 904").collect()}
    assert got[901]["kept"] and not got[902]["kept"]            # words of the text
    assert got[903]["kept"] and got[903]["class_distance"] == 0  # nothing but itself to compare with
    assert got[904]["base_failed"] or got[904]["kept"]           # characters of the text


def test_junk_is_dropped_and_no_python_runs(spark, odd_docs, no_docs):
    junk = spark.createDataFrame([(900, " ".join(["word%%%", "other$$$", "thing&&&"] * 3 + [f"w{i}***" for i in range(60)]),
                                   "en", "a", 1)], odd_docs.schema)
    out = quality_rules(odd_docs.union(junk))
    assert out.where("doc_id = 900").first()["kept"] is False
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality_rules(no_docs).count() == 0
