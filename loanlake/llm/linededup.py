"""Line dedup over overlapping three-line windows, DataFrame functions only.

Every run of three consecutive lines (split at \\n, at least one with a word) is
hashed to 128 bits. A window found again later (order: document id, null ids
last, then a hash of the text, then place) marks its three lines; marks of
overlapping windows merge, and marked lines go. The first occurrence stays.

Rows that agree in id and text are one occurrence: all stay or lose the same
lines. A null text stays null, texts under three lines and windows without a
word are never touched. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stable


def _windows(lines: Column) -> Column:
    last = F.size(lines) - 3

    def window(i: Column) -> Column:
        a, b, c = (F.get(lines, i + k) for k in range(3))
        worded = F.rlike(F.concat_ws(" ", a, b, c), F.lit(WORD))
        return F.struct(i.alias("pos"), F.xxhash64(a, b, c).alias("h1"),
                        F.xxhash64(F.lit(7), c, b, a).alias("h2"), worded.alias("worded"))

    return F.when(last >= 0, F.filter(F.transform(F.sequence(F.lit(0), last), window), lambda w: w["worded"]))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, positions) of the line windows that occurred earlier."""
    text = F.col(text_col)
    lines = docs.where(text.isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n", -1).alias("lines"))
    each = stable(lines.select("doc_id", "text_hash", F.explode(_windows(F.col("lines"))).alias("w"))
                  .select("doc_id", "text_hash", "w.pos", "w.h1", "w.h2"))
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "pos")
    spread = each.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    again = stable(spread.where(F.col("first") < F.col("last")).select("h1", "h2", "first"))
    later = each.join(again, ["h1", "h2"]).where(at > F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("positions"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus n_lines and n_removed
    (names that clash with existing columns replace them)."""
    text = F.col(text_col)
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    marks = stable(repeated_lines(docs, id_col, text_col)).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "positions")
    keyed = docs.select(*keep).withColumn("_text_hash", F.xxhash64(text))
    joined = keyed.join(marks, keyed[id_col].eqNullSafe(marks["_id"]) & (F.col("_text_hash") == F.col("_hash")), "left")
    lines = F.split(text, "\n", -1)
    gone = F.array_distinct(F.flatten(F.transform("positions", lambda p: F.array(p, p + 1, p + 2))))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    shaped = (joined.withColumn("_lines", F.when(text.isNotNull(), lines))
              .withColumn("_gone", F.when(F.col("positions").isNotNull(), gone)))
    out = shaped.withColumn(text_col, F.when(F.col("_gone").isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")))
    return out.select(*keep, F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
                      F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"))
