import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from loanlake.llm.packing import Encoder, _lengths, pack_documents, tail_bins
from loanlake.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_lengths_cover_every_document():
    for n in [*range(1, 2100), 99_999]:
        got = _lengths(n, 1024, 0.025)
        assert sum(x for x, _ in got) == n and all(1 <= x <= 1024 // k for x, k in got)
        assert len(got) <= n // 1024 + 6


def test_equal_documents_of_any_length_leave_little_padding():
    for n in range(1, 1025):
        used = sequences = 0
        for length, k in _lengths(n, 1024, 0.025):
            used += 10_000 * length
            sequences += 10_000 // k
        assert sequences * 1024 < 1.05 * used, n


def test_tails_of_all_classes_share_sequences():
    lengths = [x for n in range(1, 1025) for x, _ in _lengths(n, 1024, 0.025)][:3000]
    bins = tail_bins(lengths, 1024)
    at = defaultdict(list)
    for (b, o), n in zip(bins, lengths):
        at[b].append((o, n))
    for parts in at.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 1024
    assert len(at) <= 1.01 * sum(lengths) / 1024 + 1 and tail_bins([], 1024) == []


def test_encoder_equals_whole_texts(spark, whole):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", "  two  spaces ", "it's  we'll  nb em 　 x", "a \x1c b \x85 c", " lead", "trail ", "1 2  3\n\n 4 ",
              "<|endoftext|> x", "end <|endoftext|> x", "a<|endoftext|>b <|endoftext|><|endoftext|> <|endof text|>", " <|endoftext|>",
              "日本 語 ab", "\n \n", "a​ b é è",
              "don't 'tis we're x's. \"quoted,\" (brackets) e.g. U.S.A... a-b_c/d=1;2 é. ñ! ''ll '", "a.b.c 'S 'LL x'Ll"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(b) for b in raw])
    ids, counts = Encoder(tokenizer_path()).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    at = 0
    for t, n in zip(texts, counts.tolist()):
        assert ids[at:at + n].tolist() == whole(t), t[:80]
        at += n


def test_pieces_and_sequences(odd_docs, odd_rows, no_docs, clash, whole):
    rows = pack_documents(clash(odd_docs), tokenizer_path(), with_ids=True).collect()
    want = sorted((d is None, d or 0, whole(t) + [0]) for d, t, *_ in odd_rows)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, pieces in by_doc.items():
        texts = [ids for none, i, ids in want if (None if none else i) == d]
        assert sorted(p["doc_tokens"] for p in pieces if p["start"] == 0) == sorted(map(len, texts))
        if len(texts) == 1:
            pieces.sort(key=lambda p: p["start"])
            assert [i for p in pieces for i in p["ids"]] == texts[0]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r["length"] for r in rows) == sum(len(w[2]) for w in want)
    assert pack_documents(no_docs, tokenizer_path()).count() == 0


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    few = docs.limit(40)
    tiny = docs.selectExpr("doc_id", "cast(doc_id % 20 as string) as text")
    for table, most in ((docs, 0.02), (few, 0.03), (tiny, 0.03)):
        used = defaultdict(int)
        for r in pack_documents(table, tokenizer_path()).collect():
            used[r["sequence_id"]] += r["length"]
        pad = sum(0 if n & (n - 1) == 0 else 1024 - n for n in used.values())
        assert pad < most * sum(used.values()) + 1024


def test_shuffled_sequences_part_the_copies(spark):
    rows = [(i, f"text number {i} of some words") for i in range(300)] * 3 + [(None, None)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for shuffled in (False, True):
        at = defaultdict(list)
        for r in pack_documents(docs, tokenizer_path(), shuffled=shuffled).collect():
            at[r["doc_id"]].append(r["sequence_id"])
        together = sum(len(set(s)) < len(s) for d, s in at.items() if d is not None)
        assert together < 150 if shuffled else together > 250
        assert sum(map(len, at.values())) >= len(rows)


def test_encoder_holds_few_tokenizer_objects_at_once():
    """20,000 new cuttings in one call: the tokenizer gets them in small batches, ids are those of whole texts."""
    texts = [" ".join(f"w{i * 40 + j}x" for j in range(40)) for i in range(500)] + ["", "w1x été w1x"]
    encoder, sizes = Encoder(tokenizer_path()), []
    tokenizer = encoder.tokenizer

    class Watched:
        def encode_batch_fast(self, batch, **kw):
            sizes.append(len(batch))
            return tokenizer.encode_batch_fast(batch, **kw)

    encoder.tokenizer = Watched()
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    flat, counts = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]
    assert max(sizes) <= 4096 < sum(sizes)
