"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A text's words (runs of ASCII letters, digits and non-ASCII bytes, lower-cased)
are read in overlapping windows. A word's input joins a word embedding with the
largest components among the embeddings of its character 4- and 7-grams (in
bytes, the word's start included), all hashed. A gated recurrent unit runs over
the window in each direction; each direction's states are pooled by a learned
attention into the window's logit. A text's logit is the highest of its windows,
scaled by a logistic fit on the training documents: a toxic passage counts alike in
a short text and in a very long one.

The network is trained in numpy on the driver from at most ``sample`` labelled
documents of each class (a documented bound, drawn by a hash of the id; at most
``MAX_WINDOWS`` windows of each). A label belongs to a whole text, so each round
learns from one window of each, drawn by its present odds. Embeddings start from
shrunken log-odds of their words and grams in the sample.

A null or wordless text scores the network's value for an empty window. Without
labels of both classes every text scores the share of label 1 (0 if there are no
labels). Repeated rows score alike; several labels of an id count as the largest.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, mix64, ranges, slices, span_hashes, spaced, utf8

WINDOW, STRIDE, HIDDEN, EMBED, BITS = 128, 64, 8, 4, 16
SAMPLE, MAX_WINDOWS, EPOCHS, BATCH = 1500, 16, 14, 128


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, ends, first): lower-cased bytes, 0 between words; the spans of
    the words; the number of the first word of each text."""
    text, at = spaced(buf, offsets)
    table = np.zeros(256, np.uint8)
    for c in (*range(48, 58), *range(97, 123), *range(128, 256)):
        table[c] = c
    table[65:91] = table[97:123]
    text = table[text]
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = text > 0
    step = np.diff(inside)
    starts = np.flatnonzero(step == 1)
    return text, starts, np.flatnonzero(step == -1), np.searchsorted(starts, at)


def codes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word; buckets of the 4-gram and the 7-gram from the byte before each byte."""
    word = (span_hashes(text, starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)
    p = np.concatenate([[0], text, np.zeros(5, np.uint8)]).astype(np.uint32)
    n, live = len(text), np.ones(len(text), np.uint32)
    short = long = p[:n] * np.uint32(0x01000193)
    for k in range(1, 7):  # bytes after the word's end count as none
        live = live * (p[k:n + k] > 0)
        long = (long ^ (p[k:n + k] * live)) * np.uint32(0x9E3779B1)
        long ^= long >> np.uint32(15)
        short = long if k == 3 else short
    shift = np.uint32(32 - BITS)
    return word, (short >> shift).astype(np.int64), ((long * np.uint32(0x85EBCA6B)) >> shift).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Network:
    """Weights as float32 arrays; both directions run as one block-diagonal step."""

    def __init__(self, seed: int = 3):
        r, h, d = np.random.default_rng(seed), HIDDEN, 2 * EMBED
        self.words = (0.05 * r.standard_normal((1 << BITS, EMBED))).astype(np.float32)
        self.grams = (0.05 * r.standard_normal((1 << BITS, EMBED))).astype(np.float32)
        self.scale = (1.0, 0.0)
        self.dense = {
            "x": (r.standard_normal((d, 6 * h)) / np.sqrt(d)).astype(np.float32),
            "bias": np.zeros(6 * h, np.float32),
            "u": (r.standard_normal((2, h, 3 * h)) / np.sqrt(h)).astype(np.float32) * 0.5,
            "attend": (0.3 * r.standard_normal((2, h))).astype(np.float32),
            "out": (r.standard_normal(2 * h) / np.sqrt(2 * h)).astype(np.float32),
            "b": np.zeros(1, np.float32)}

    def inputs(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        word, short, long = codes(text, starts, ends)
        if not len(word):
            return np.zeros((0, 2 * EMBED), np.float32)
        # grams past a word's end belong to none; the text between words is skipped by the odd cuts
        both = np.maximum(self.grams[short], self.grams[long])
        cuts = np.stack([starts, ends], axis=1).ravel()
        top = np.maximum.reduceat(both, np.minimum(cuts, len(text) - 1), axis=0)[::2]
        return np.concatenate([self.words[word], top], axis=1)

    def run(self, x: np.ndarray, starts: np.ndarray, lens: np.ndarray, keep: bool = False):
        """Logits of windows of ``lens`` words from ``starts`` in ``x``; with ``keep``, what training needs."""
        h, w, n = HIDDEN, self.dense, len(starts)
        steps = max(1, int(lens.max(initial=0)))
        if not len(x):
            x = np.zeros((1, 2 * EMBED), np.float32)
        gates = x @ w["x"] + w["bias"]
        last = len(x) - 1
        state = np.zeros((2, n, h), np.float32)
        top, total = np.zeros((2, n, h), np.float32), np.full((2, n, 1), 1e-6, np.float32)
        tape = []
        for t in range(steps):
            on = (t < lens).astype(np.float32)[:, None]
            at = np.minimum(starts + t, last), np.clip(starts + lens - 1 - t, 0, last)
            g = np.stack([gates[at[0], :3 * h], gates[at[1], 3 * h:]])
            a = state @ w["u"]
            zr = _sigmoid(g[..., :2 * h] + a[..., :2 * h])
            z, r = zr[..., :h], zr[..., h:]
            new = np.tanh(g[..., 2 * h:] + r * a[..., 2 * h:])
            before, state = state, new + z * (state - new)
            e = np.exp(np.einsum("dnh,dh->dn", state, w["attend"]))[..., None] * on
            top += e * state
            total += e
            if keep:
                tape.append((at, z, r, new, a[..., 2 * h:], before, state, e))
        pooled = top / total
        logit = np.concatenate([pooled[0], pooled[1]], axis=1) @ w["out"] + w["b"]
        return (logit, tape, pooled, total, x) if keep else logit

    def gradients(self, slope: np.ndarray, tape: list, pooled: np.ndarray, total: np.ndarray, x: np.ndarray):
        """Gradients of the dense weights and of the inputs for the slope of the loss by the logits."""
        h, w, n = HIDDEN, self.dense, len(slope)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["out"] = np.concatenate([pooled[0], pooled[1]], axis=1).T @ slope
        g["b"] = slope.sum(keepdims=True)
        d_pool = np.stack([slope[:, None] * w["out"][:h], slope[:, None] * w["out"][h:]])
        d_gates, d_state = np.zeros((len(x), 6 * h), np.float32), np.zeros((2, n, h), np.float32)
        for at, z, r, new, a_n, before, state, e in reversed(tape):
            share = e / total
            d_e = (d_pool * (state - pooled)).sum(axis=2, keepdims=True) * share
            g["attend"] += (d_e * state).sum(axis=1)
            d_state = d_state + d_pool * share + d_e * w["attend"][:, None, :]
            d_new = d_state * (1 - z) * (1 - new * new)
            d_z = d_state * (before - new) * z * (1 - z)
            d_r = d_new * a_n * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_new * r], axis=2)
            g["u"] += np.einsum("dnh,dng->dhg", before, d_a)
            d_g = np.concatenate([d_z, d_r, d_new], axis=2)
            np.add.at(d_gates[:, :3 * h], at[0], d_g[0])
            np.add.at(d_gates[:, 3 * h:], at[1], d_g[1])
            d_state = d_state * z + d_a @ w["u"].transpose(0, 2, 1)
        g["x"], g["bias"] = x.T @ d_gates, d_gates.sum(axis=0)
        return g, d_gates @ w["x"].T

    def scores(self, buf: np.ndarray, offsets: np.ndarray, batch: int = 1024) -> np.ndarray:
        """Score of each text: the logistic of its highest window."""
        text, starts, ends, first = words(buf, offsets)
        owner, at, lens = windows(first)
        x = self.inputs(text, starts, ends)
        logit = np.empty(len(at), np.float32)
        by_length = np.argsort(lens, kind="stable")
        for lo in range(0, len(at), batch):
            part = by_length[lo:lo + batch]
            span = ranges(at[part], at[part] + lens[part])
            local = np.cumsum(lens[part]) - lens[part]
            logit[part] = self.run(x[span], local, lens[part])
        return _sigmoid(self.scale[0] * highest_logit(logit, owner, len(offsets) - 1) + self.scale[1])


def highest_logit(logit: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The highest of each text's windows."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, logit.astype(np.float64))
    return top


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0.1) and offset of a weighted logistic fit by Newton steps, slightly damped."""
    w = np.array([1.0, 0.0])
    a = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = _sigmoid(a @ w)
        g = a.T @ (weight * (p - y)) + 1e-3 * (w - [1.0, 0.0]) * len(x) / 100
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-3 * max(1, len(x) / 100)
        w = w - np.clip(np.linalg.solve(h, g), -1, 1)
    return max(0.1, float(w[0])), float(w[1])


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of all windows; a text without words has one empty window."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(n)), count)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return owner, first[:-1][owner] + k * STRIDE, np.clip(n[owner] - k * STRIDE, 0, WINDOW)


def _coded(text: bytes) -> tuple[np.ndarray, ...]:
    """Of a document's windows (one a line): word buckets, the two gram buckets of each
    byte inside words, bytes of each word, words of each window."""
    lines = text.split(b"\n")
    raw = np.frombuffer(b"".join(lines) or b" ", np.uint8)
    low, starts, ends, first = words(raw, np.concatenate([[0], np.cumsum([len(x) for x in lines])]) if len(lines) > 1
                                     else np.array([0, len(raw)]))
    word, short, long = codes(low, starts, ends)
    inside = ranges(starts, ends)
    return (word.astype(np.uint16), short[inside].astype(np.uint16), long[inside].astype(np.uint16),
            (ends - starts).astype(np.int32), np.diff(first))


def _log_odds(buckets: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Shrunken log-odds of label 1 by bucket, each document counted once."""
    counts = np.zeros((2, 1 << BITS))
    for b, y in zip(buckets, label, strict=True):
        counts[int(y), np.unique(b)] += 1
    rate = label.mean()
    return np.log((counts[1] + 5 * rate) / (counts[0] + 5 * (1 - rate)) * (1 - rate) / rate).astype(np.float32)


def train(texts: list[bytes], labels: np.ndarray, share: float | None = None, epochs: int = EPOCHS,
          rate: float = 0.01, seed: int = 3) -> Network:
    """``texts``: the chosen windows of a document, one a line. ``share``: of label 1 among
    all documents, where the sample has another."""
    net, rng = Network(seed), np.random.default_rng(seed)
    corpus = [_coded(t) for t in texts]  # one document at a time: what is kept is a few bytes per byte of text
    word, short, long, width, lens = (np.concatenate([c[k] for c in corpus]) for k in range(5))
    doc = np.repeat(np.arange(len(texts)), [len(c[4]) for c in corpus])
    first = np.concatenate([[0], np.cumsum(lens)])
    at_byte = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    net.words[:, 0] = _log_odds([c[0] for c in corpus], labels)
    net.grams[:, 0] = _log_odds([np.concatenate(c[1:3]) for c in corpus], labels)
    del corpus

    def read(part: np.ndarray) -> tuple:
        """Inputs of some windows, and where they come from."""
        span = ranges(first[part], first[part + 1])
        inner = ranges(at_byte[span], at_byte[span + 1])
        both = np.stack([net.grams[short[inner]], net.grams[long[inner]]])
        if not len(span):
            return np.zeros((0, 2 * EMBED), np.float32), span, inner, both
        cut = np.cumsum(width[span], dtype=np.int64) - width[span]
        return np.concatenate([net.words[word[span]], np.maximum.reduceat(both.max(axis=0), cut, axis=0)], axis=1), span, inner, both

    def logits() -> np.ndarray:
        out = []
        for lo in range(0, len(lens), 512):
            part = np.arange(lo, min(lo + 512, len(lens)))
            out.append(net.run(read(part)[0], np.cumsum(lens[part]) - lens[part], lens[part]).astype(np.float64))
        return np.concatenate(out)

    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.dense.items()}
    seen = [np.full((1 << BITS, 1), 1e-3, np.float32) for _ in range(2)]
    step = 0
    for _ in range(epochs):
        drawn = logits() + rng.gumbel(size=len(lens))  # the largest is a draw by odds
        order = np.lexsort((-drawn, doc))
        chosen = order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])]
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // BATCH)):
            xs, span, inner, both = read(part)
            if not len(span):
                continue
            out, tape, pooled, total, xs = net.run(xs, np.cumsum(lens[part]) - lens[part], lens[part], keep=True)
            slope = ((_sigmoid(out) - labels[doc[part]]) / len(part)).astype(np.float32)
            grad, d_x = net.gradients(slope, tape, pooled, total, xs)
            step += 1
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.dense[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            owner = np.repeat(np.arange(len(span)), width[span])
            from_top = (both == xs[owner, EMBED:]) * d_x[owner, EMBED:]
            for table, rows, d, past in ((net.words, word[span], d_x[:, :EMBED], seen[0]),
                                         (net.grams, np.concatenate([short[inner], long[inner]]),
                                          from_top.reshape(-1, EMBED), seen[1])):
                moved = np.flatnonzero(d.any(axis=1))
                at, slot = np.unique(rows[moved], return_inverse=True)
                g = np.zeros((len(at), EMBED), np.float32)
                np.add.at(g, slot, d[moved].astype(np.float32))
                past[at] += (g * g).mean(axis=1, keepdims=True)
                table[at] -= 0.02 * g / np.sqrt(past[at])
    share = labels.mean() if share is None else share
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    net.scale = fit_logistic(highest_logit(logits(), doc, len(texts)), labels, weight)
    return net


def _sampled(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(doc_id, label, lines): up to ``sample`` labelled documents a class, each by some of its windows."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    # a bounded draw of each class
    drawn = [marked.where(F.col("label") == y).orderBy(F.xxhash64(F.lit(9), "_id"), "_id").limit(sample) for y in (0, 1)]
    known = drawn[0].unionByName(drawn[1])
    found = docs.join(F.broadcast(known), F.col(id_col) == F.col("_id")).groupBy("_id", "label").agg(
        F.min(text_col).alias("text"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = utf8(batch.column(2))
            out = []
            for i in range(batch.num_rows):
                text, starts, ends, first = words(buf, offsets[i:i + 2])
                _, at, lens = windows(first)
                keep = np.sort(np.argsort(mix64(np.arange(len(at), dtype=np.uint64) + np.uint64(i)))[:MAX_WINDOWS])
                whole = text.tobytes().replace(b"\0", b" ")
                out.append(b"\n".join(whole[starts[a]:ends[a + n - 1]] if n else b""
                                      for a, n in zip(at[keep].tolist(), lens[keep].tolist(), strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["doc_id", "label", "lines"])

    return found.select(F.col("_id").cast("long").alias("doc_id"), "label", "text").mapInArrow(
        pick, "doc_id long, label int, lines binary")


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 5, held_fold: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of the held-out fold are not learned from."""
    fold = crc_mod(id_col, folds)
    known = labels.where(fold != held_fold)
    rows = _sampled(docs, known, sample, id_col, text_col, label_col).orderBy("doc_id").collect()
    marks = np.array([r["label"] for r in rows], np.float64)
    share = known.agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    net = None
    if len(set(marks.tolist())) == 2:
        net = train([bytes(r["lines"]) for r in rows], marks, min(max(share, 0.01), 0.99))
    flat = float(marks.mean()) if len(marks) else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = utf8(batch.column(2))
            parts = [net.scores(buf, offsets[lo:hi + 1]) if net else np.full(hi - lo, flat)
                     for lo, hi in slices(offsets, 1 << 20)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), (fold == held_fold).alias("held_out"), F.col(text_col)).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int")
