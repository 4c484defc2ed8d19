"""The pipeline against its parts run by brute force on a small corpus."""

import importlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from .test_jaccard_join import brute
from .test_linededup import plain

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    whole = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "12 34 !!", "en", "src0", 8),
                                   (None, "the cat and the dog of the house", "en", "src1", 3)], whole.schema)
    path = str(tmp_path_factory.mktemp("sf"))
    whole.unionByName(extra).unionByName(whole.limit(5)).write.parquet(f"{path}/documents.parquet")
    return path


def stages(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], path).cache())
    return out


def test_stages_keep_the_columns_and_decide(spark, corpus):
    docs, known, lined, single, mixed, packed = stages(spark, corpus)
    for df in (known, lined, single, mixed):
        assert df.columns == docs.columns and df.schema.names == docs.schema.names
    rows = [[tuple(r) for r in df.collect()] for df in (docs, known, lined, single, mixed)]
    lettered = [r for r in rows[0] if any(c.isalpha() for c in r[1] or "")]
    assert set(rows[1]) <= set(lettered) and len(rows[1]) >= 0.97 * len(lettered)
    # line dedup by dictionaries
    _, occurrences = plain([r[:2] for r in rows[1]])
    gone = defaultdict(set)
    for places in occurrences.values():
        for none, d, t, i in sorted(places)[1:]:
            gone[None if none else d, t].update((i, i + 1, i + 2))
    want = []
    for d, t, *_ in rows[1]:
        cut = gone.get((d, t), set())
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut)
        if not cut or re.search("[^ \t\n\x0b\x0c\r]", kept):
            want.append((d, kept))
    assert sorted((r[:2] for r in rows[2]), key=repr) == sorted(want, key=repr)
    assert all(r[4] == len(r[1]) for r in rows[2] if (r[0], r[1]) not in {x[:2] for x in rows[1]})
    # one of each group stays
    component = {d: c for d, n, c in brute([r[:2] for r in rows[2]]) if d is not None}
    assert sorted(r[0] for r in rows[3] if r[0] is not None) == sorted(set(component.values()))
    # the mix repeats and cuts whole texts only
    texts = {r[0]: r[1] for r in rows[3]}
    assert all(texts[r[0]].startswith(r[1]) for r in rows[4])
    tokens = defaultdict(int)
    for r in packed.collect():
        tokens[r["doc_id"]] += r["length"]
    assert tokens.keys() == {r[0] for r in rows[4]}
    pieces = defaultdict(list)
    for r in packed.collect():
        pieces[r["doc_id"], r["start"], r["length"], r["ids_crc32"]].append(r["sequence_id"])
    several = [s for s in pieces.values() if len(s) > 1]
    # few sequences here, so some copies meet by chance; in order of ids four of five would
    assert several and sum(len(set(s)) < len(s) for s in several) < 0.5 * len(several)


def test_other_columns_pass_through_unchanged(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names = ["score", "held_out", "lang_pred", "n_removed", "n_lines", "_size", "_turn", "_rounds", "_gone", "_copy", "node", "gone",
             "size", "h1", "idx", "_part", "tokens", "Words", "shard", "row"]
    marked = docs
    for c in names:
        marked = marked.withColumn(c, F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    plain = docs
    for name, stage in pipeline.STAGES[:-1]:
        marked, plain = stage(spark, marked, corpus).cache(), stage(spark, plain, corpus).cache()
        assert marked.columns == [*docs.columns, *names], name
        rows = marked.collect()
        assert all(r[c] == c + ("-" if r["doc_id"] is None else str(r["doc_id"])) for r in rows for c in names), name
        key = lambda df: sorted((tuple(r[:5]) for r in df.collect()), key=repr)
        assert key(marked) == key(plain), name
    assert pipeline.STAGES[-1][1](spark, marked, corpus).count() == pipeline.STAGES[-1][1](spark, plain, corpus).count()


def test_texts_that_reuse_an_id_stay(spark, corpus):
    stage = dict(pipeline.STAGES)["near_copies"]
    schema = spark.read.parquet(f"{corpus}/documents.parquet").schema
    text = lambda k: " ".join(f"{x}{k}" for x in "abcdefghijklmnopqrst")
    rows = [(1, text(1), "en", "a", 1), (1, text(2), "en", "a", 1), (1, text(2), "en", "a", 1), (2, text(2) + " more", "en", "a", 1),
            (3, text(3), "en", "a", 1), (4, text(3), "en", "a", 1), (-5, text(1), "en", "a", 1), (5, text(5), None, None, None)]
    for largest in (5, (1 << 63) - 1):
        table = spark.createDataFrame([(largest, *r[1:]) if r[0] == 5 else r for r in rows], schema)
        got = sorted((r["doc_id"], r["text"]) for r in stage(spark, table, corpus).collect())
        texts = sorted({t[:4] for _, t in got})
        assert len(got) == 4 == len(texts), got
        assert {(3, text(3)), (largest, text(5))} <= set(got)


def test_run_equals_its_stages(spark, corpus):
    count = lambda df: sorted((tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32").collect()), key=repr)
    assert count(pipeline.run(spark, corpus)) == count(stages(spark, corpus)[-1])


def test_entry_lists_everything():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
