"""Quality rules by distribution divergence, DataFrame functions only.

Each text gets two histograms: code points by character class, and its words by
a fixed list of common function words (others together). References are the
summed histograms of all documents with the same ``lang`` (null is a group of
its own). A text is kept if it passes the base rules and both Jensen-Shannon
distances (square root of the base-2 divergence, 0 to 1) to its reference stay
within their limits. Texts under ``min_words`` words or ``min_chars`` characters in
words have no steady histogram, nor has a reference of under ``min_reference`` words
beside the text's own: there the divergence test is not applied (the base rules still are).

A null or wordless text has zero counts and fails the base rules, as any text
under 50 words does. Repeated rows are judged alike; extra columns are left out.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stable

#: Frequent function words of English, French, German and Spanish.
COMMON_WORDS = ("the", "of", "and", "to", "in", "is", "that", "with",
                "la", "les", "des", "et", "une", "est", "pour", "dans",
                "der", "die", "und", "den", "von", "mit", "ist", "nicht",
                "el", "los", "que", "del", "por", "con", "una", "y")
SYMBOLS = r"[#*$%&|<>]"
SPACES = " \t\n\x0b\f\r"
#: Character classes in the order they are counted; what is left is the last class.
CLASSES = (r"[\p{Ll}]", r"[\x20\x09-\x0D]", r"[\p{Lu}]", r"[0-9]", r"[.,;:!?'\"()\-]", SYMBOLS)
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.45
#: Length guards: words and characters in words of a text, words of its reference.
MIN_WORDS, MIN_CHARS, MIN_REFERENCE = 64, 320, 1000
#: References (one row per language, under 1 kB) that may be broadcast.
BROADCAST_LANGUAGES = 10_000


def _window_hashes(words: Column) -> Column:
    """A hash of each three-word window, in order."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                       lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and both histograms of each document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text.alias("text"))
    trimmed = F.btrim("text", F.lit(SPACES))
    d = d.withColumn("n_all", F.char_length("text")).withColumn(
        "words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACES}]+", -1)))
    d = d.withColumn("rest", F.regexp_replace("text", CLASSES[0] + "+", "")).withColumn(
        "lined", F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))).drop("text")
    d = d.withColumn("c0", F.col("n_all") - F.char_length("rest"))
    for k, c in enumerate(CLASSES[1:], 1):
        d = d.withColumn("next", F.regexp_replace("rest", c + "+", "")).withColumn(
            f"c{k}", F.char_length("rest") - F.char_length("next")).withColumn("rest", F.col("next")).drop("next")
    d = d.withColumn("hashes", _window_hashes(F.col("words"))).withColumn(
        "common", F.array_join(F.transform(
            F.filter("words", lambda w: F.lower(w).isin(list(COMMON_WORDS))),
            lambda w: F.char(F.array_position(F.lit(list(COMMON_WORDS)), F.lower(w)) + 63)), ""))
    d = d.withColumn("n_words", F.size("words").cast("long")).drop("words")
    # positions of windows whose hash stands beside an equal one once sorted
    paired = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("paired", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), paired))
    twin = F.filter("paired", lambda p, i: (p["h"] == F.get(F.col("paired"), i - 1)["h"])
                    | (p["h"] == F.get(F.col("paired"), i + 1)["h"]))
    d = d.withColumn("at", F.sort_array(F.transform(twin, lambda p: p["i"]))).drop("paired", "hashes")
    span = F.aggregate("at", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                       lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")),
                       lambda s: s["n"])
    # one letter per common word, from '@' on: what a removal shortens is its count
    n_common = F.length("common").cast("long")
    counts = [n_common - F.length(F.replace("common", F.lit(chr(64 + k)), F.lit(""))) for k in range(len(COMMON_WORDS))]
    return d.select(
        "doc_id", "lang", "n_words", F.col("n_all").cast("long").alias("n_all"), (F.col("n_all") - F.col("c1")).cast("long").alias("word_chars"),
        F.col(f"c{len(CLASSES) - 1}").cast("long").alias("n_symbols"),
        (F.size("lined") - F.size(F.array_distinct("lined"))).cast("long").alias("n_dup_lines"),
        F.coalesce(span, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*[F.col(f"c{k}").cast("long") for k in range(len(CLASSES))], F.char_length("rest").cast("long")).alias("classes"),
        F.array(*counts, F.col("n_words") - n_common).alias("common"))


def _distance(counts: Column, total: Column, ref: Column, ref_total: Column) -> Column:
    """Jensen-Shannon distance of two histograms, each with its sum."""
    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    parts = F.zip_with(counts, ref, lambda x, y: term(x / total, y / ref_total) + term(y / ref_total, x / total))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / 2))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, min_reference: int = MIN_REFERENCE,
                  max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Base counts, distances and verdict of each document."""
    each = stable(features(docs, id_col, text_col, lang_col))
    sizes = {"classes": len(CLASSES) + 1, "common": len(COMMON_WORDS) + 1}
    ref = stable(each.groupBy(F.col("lang").alias("_lang")).agg(
        *[F.array(*[F.sum(F.col(c)[k]) for k in range(n)]).alias(f"ref_{c}") for c, n in sizes.items()],
        F.sum("n_all").alias("ref_all"), F.sum("n_words").alias("ref_words")))
    few = ref.count() <= BROADCAST_LANGUAGES
    out = each.join(F.broadcast(ref) if few else ref, F.col("lang").eqNullSafe(F.col("_lang")))
    class_distance = _distance(F.col("classes"), F.col("n_all"), F.col("ref_classes"), F.col("ref_all"))
    word_distance = _distance(F.col("common"), F.col("n_words"), F.col("ref_common"), F.col("ref_words"))
    worded = F.col("n_words") > 0
    out = (out.withColumn("class_distance", F.when(worded, F.round(class_distance, 4)))
           .withColumn("word_distance", F.when(worded, F.round(word_distance, 4)))
           .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    near = (F.col("class_distance") <= max_class) & (F.col("word_distance") <= max_word)
    short = (F.col("n_words") < min_words) | (F.col("word_chars") < min_chars) | (F.col("ref_words") - F.col("n_words") < min_reference)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & (short | near)).alias("kept"),
                      "class_distance", "word_distance")
