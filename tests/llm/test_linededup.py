import re
from collections import Counter

from loanlake.llm.linededup import dedup_lines

WORD = re.compile(r"[^ \t\n\x0b\x0c\r]")


def plain(rows):
    """The same by dictionaries; equal (id, text) rows count as one."""
    docs = sorted({(d is None, d if d is not None else 0, t) for d, t in rows if t is not None})
    occurrences = {}
    for none, d, t in docs:
        lines = t.split("\n")
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if WORD.search(" ".join(w)):
                occurrences.setdefault(w, []).append((none, d, t, i))
    return docs, occurrences


def test_matches_brute_force(odd_docs, odd_rows, clash):
    docs, occurrences = plain([(r[0], r[1]) for r in odd_rows])
    gone = {}
    for places in occurrences.values():
        ids = {p[:2] for p in places}
        for none, d, t, i in sorted(places)[1:]:
            gone.setdefault((d if not none else None, t), set()).update((i, i + 1, i + 2))
        assert len(ids) < len(places) + 1
    want = []
    for d, t, *_ in odd_rows:
        lines = None if t is None else t.split("\n")
        cut = gone.get((d, t), set())
        kept = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in cut)
        want.append((d, kept, len(lines or []), len(cut)))
    out = dedup_lines(clash(odd_docs))
    # texts of one id keep a hash order of their own, so compare the unambiguous ids
    free = {d for d, n in Counter(d for d, _ in {(r[0], r[1]) for r in odd_rows}).items() if n == 1}
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()]
    assert Counter(g for g in got if g[0] in free) == Counter(w for w in want if w[0] in free)
    assert len(got) == len(want) and sum(g[3] for g in got) >= 18
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_overlapping_windows_merge(spark):
    body = "a 1\nb 2\nc 3\nd 4\ne 5"
    docs = spark.createDataFrame([(2, f"x\n{body}\ny"), (1, body), (3, "c 3\nd 4"), (4, f"{body}\n{body}"), (5, "\n\n\n\n"),
                                  (6, "\n\n\n\n")], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(docs).collect()}
    assert got == {1: (body, 0), 2: ("x\ny", 5), 3: ("c 3\nd 4", 0), 4: ("", 10), 5: ("\n\n\n\n", 0), 6: ("\n\n\n\n", 0)}


def test_empty_table(no_docs):
    assert dedup_lines(no_docs).count() == 0
