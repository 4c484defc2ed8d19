"""Language identification by rank-order n-gram profiles.

Letters are lower-cased, anything else ends a word. The 1- to 3-grams of a text
(word ends count as a character in 2- and 3-grams) are ranked by frequency; the
distance of a text to a language is the sum over its ``top`` n-grams of the
places between their ranks in text and profile (out of place), ``top`` for one
the profile lacks. The least mean distance wins, ties go to the smaller name;
score = 1 - distance / top.

Profiles come from about ``per_lang`` documents of each language, picked by a
hash of id and text among the labelled rows of the training folds (a documented
bound); every document is predicted from its whole text. A null text, or one
without a letter, is ``und`` with score 0, as is any text if nothing could be
learned. Repeated rows and ids are predicted alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, slices, utf8

TOP, PER_LANG, UNKNOWN = 300, 2000, "und"
#: Texts of a slice; a gram's key holds the text's number in 8 bits and its code in 56.
_ROWS, _BYTES = 256, 1 << 20
_CODE = np.uint64(56)


def _letters() -> np.ndarray:
    """The number of each code point among all letters, from 1; 0 for what is none. Unicode
    has fewer letters than 18 bits hold."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.cumsum(letter), 0).astype(np.uint64)


def _grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, gram code, count), ordered by the first two. A code is the gram
    length and three letters of 18 bits by their numbers (0 is a word end), one for each gram."""
    low = [t.lower() for t in texts]
    cp = np.frombuffer("".join(x + "\n" for x in low).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter((len(x) + 1 for x in low), np.int64, len(low))
    owner = np.repeat(np.arange(len(low), dtype=np.uint64), lens)
    number = letters[cp]
    keep = number > 0
    keep[1:] |= number[:-1] > 0  # the first of several word ends stays
    c, d = number[keep], owner[keep]
    if not len(c):
        return (np.zeros(0, np.int64),) * 3
    before = np.concatenate([[np.uint64(0)], c[:-1]])
    after = np.concatenate([c[1:], [np.uint64(0)]])
    text, solid = d << _CODE, c > 0
    one = (text | (np.uint64(1) << np.uint64(54)) | c)[solid]
    two = (text | (np.uint64(2) << np.uint64(54)) | (before << np.uint64(18)) | c)[solid | (before > 0)]
    three = (text | (np.uint64(3) << np.uint64(54)) | (before << np.uint64(36)) | (c << np.uint64(18)) | after)[solid]
    keys = np.sort(np.concatenate([one, two, three]))
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    runs = keys[edge]
    return ((runs >> _CODE).astype(np.int64), (runs & ((np.uint64(1) << _CODE) - np.uint64(1))).astype(np.int64),
            np.diff(np.append(edge, len(keys))))


def learn_profiles(docs: DataFrame, top: int = TOP, per_lang: int = PER_LANG, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Each language's ``top`` most frequent gram codes, most frequent first."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.col(lang_col) != UNKNOWN))
    sizes = rows.groupBy(lang_col).count().withColumnRenamed(lang_col, "_lang")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(5), id_col, text_col), 11) / F.lit(float(1 << 53))
    picked = rows.join(F.broadcast(sizes), F.col(lang_col) == F.col("_lang")).where(
        draw * F.col("count") < per_lang).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(texts), _ROWS):
                owner, code, n = _grams(texts[lo:lo + _ROWS], letters)
                names = [langs[lo + i] for i in owner.tolist()]
                grams = pa.table({"lang": pa.array(names, pa.string()), "code": code, "n": n})
                yield from grams.group_by(["lang", "code"]).aggregate([("n", "sum")]).rename_columns(
                    ["lang", "code", "n"]).to_batches()

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    grams = picked.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = grams.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    out: dict[str, list[int]] = {}
    for r in ranked.orderBy("lang", "rank").select("lang", "code").collect():
        out.setdefault(r["lang"], []).append(r["code"])
    return out


def identify(docs: DataFrame, profiles: dict[str, list[int]], top: int = TOP, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (replacing columns of these names)."""
    names = sorted(profiles)
    codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
    ranks = np.full((len(codes) + 1, max(1, len(names))), -1, np.int32)
    for j, name in enumerate(names):
        ranks[np.searchsorted(codes, np.array(profiles[name], np.int64)), j] = np.arange(len(profiles[name]))
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    at_text = keep.index(text_col)

    def verdicts(texts: list[str], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        owner, code, n = _grams(texts, letters)
        # by text, then falling count; grams of one count stay in the order of their codes
        order = np.argsort((owner.astype(np.uint64) << _CODE) | ((np.uint64(1) << _CODE) - np.uint64(1) - n.astype(np.uint64)), kind="stable")
        owner, code = owner[order], code[order]
        first = np.searchsorted(owner, np.arange(len(texts)))
        place = np.arange(len(owner)) - first[owner]
        leading = place < top
        owner, code, place = owner[leading], code[leading], place[leading]
        at = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
        r = ranks[np.where(codes[at] == code, at, len(codes))] if len(codes) else np.full((len(code), 1), -1, np.int32)
        off = np.where(r < 0, top, np.minimum(np.abs(r - place[:, None]), top))
        total = np.stack([np.bincount(owner, off[:, j], len(texts)) for j in range(r.shape[1])], axis=1)
        mean = total / np.maximum(np.bincount(owner, minlength=len(texts)), 1)[:, None]
        some = (np.bincount(owner, minlength=len(texts)) > 0) & (len(names) > 0)
        best = mean.argmin(axis=1)
        score = np.where(some, 1.0 - mean[np.arange(len(texts)), best] / top, 0.0)
        return [names[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)], score

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            _, offsets = utf8(batch.column(at_text))
            for lo, hi in slices(offsets, _BYTES, _ROWS):
                part = batch.slice(lo, hi - lo)
                lang, score = verdicts([t or "" for t in part.column(at_text).to_pylist()], letters)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score)],
                                                 names=schema.names)

    return docs.select(*keep).mapInArrow(predict, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
                held_fold: int = 1, top: int = TOP, per_lang: int = PER_LANG) -> DataFrame:
    """Predict every document, learning from the labelled ones outside the held-out
    fold: the columns of ``docs`` plus held_out, lang_pred and score."""
    fold = crc_mod(id_col, folds)
    profiles = learn_profiles(docs.where(fold != held_fold), top, per_lang, id_col, text_col, lang_col)
    return identify(docs.drop("held_out"), profiles, top, text_col).withColumn("held_out", fold == held_fold)
