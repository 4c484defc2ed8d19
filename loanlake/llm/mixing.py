"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: the sources share the words of the whole corpus by weight; a target
stops at ``max_repeat`` times its source, the excess is shared again by weight.
Each source's documents stand in a seeded random order, laid over blocks of
``block_words`` words; a target of several whole rounds and a rest takes every
block once per round and the leading blocks of the order for the rest, so the
taken words miss the target by half a block at most. The exact block quotas are
split over the output shards down a binary tree: each node draws its left
half's quota vector without replacement (multivariate hypergeometric, seeded by
the node), so shards get equal block counts and disjoint blocks. A source's blocks
of all rounds are numbered and dealt to shards one by one through a permutation of
these numbers: a shard gets its quota of each source exactly, a long document and
the rounds of a repeated one go to many shards. A document's words are those of its
drawn blocks.

``mix_documents`` gives whole documents and leading parts, not loose blocks: each
copy of a document stands in the shard of its first block in that round, in the
order of a hash there, so a shard's words there follow the quotas only in the mean.

Only per-source totals (one row per source label) reach the driver. Documents
alike in id, source and text share one place; its drawn words are split over
them by number, to the word. A null or wordless text has size 0 and is
taken 0 words; a null source is a source, the last one. An empty table, or one
without words, gives targets of 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, numbered, shielded, stable

WEIGHTS, MAX_REPEAT, BLOCK_WORDS, MAX_BLOCKS = (5.0, 2.0, 1.0), 3, 64, 500_000_000
#: Blocks that one array holds while a document's blocks are listed.
_LISTED = 10_000
_KEY = ["doc_id", "source", "h1", "h2"]


def targets(sizes: Sequence[float], weights: Sequence[float], cap: float) -> list[float]:
    """Shares of the total by weight, none above ``cap`` times its size; what a
    capped source leaves goes to the others by weight."""
    out, free, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        unit = rest / sum(weights[i] for i in free)
        over = [i for i in sorted(free) if weights[i] * unit > cap * sizes[i]]
        for i in over or sorted(free):
            out[i] = cap * float(sizes[i]) if over else weights[i] * unit
        if not over:
            break
        rest -= sum(out[i] for i in over)
        free -= set(over)
    return out


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts whose columns add up to ``quotas`` and whose rows have equal sums (by one)."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(node: int, lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        left = int(have.sum()) * (mid - lo) // (hi - lo)
        draw = np.random.default_rng([seed, node]).multivariate_hypergeometric(have, left, method="marginals")
        split(2 * node, lo, mid, draw)
        split(2 * node + 1, mid, hi, have - draw)

    split(1, 0, shards, np.asarray(quotas, np.int64))
    return out


def _coprime(n: int, rng: np.random.Generator) -> int:
    while True:
        a = int(rng.integers(1, max(2, n)))
        if math.gcd(a, n) == 1:
            return a


def _keyed(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(11), text).alias("h2"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def _laid(docs: DataFrame, weights: Sequence[float], max_repeat: int, block_words: int, shards: int, seed: int,
          id_col: str, source_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(rows, each distinct row with its place in its source and the source's plan, words of a block)."""
    spark = docs.sparkSession
    rows = stable(_keyed(docs, id_col, source_col, text_col))
    totals = rows.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [int(r["n"]) for r in totals]
    share = [float(weights[i % len(weights)]) for i in range(len(totals))]
    goal = targets(sizes, share, max_repeat) if sum(sizes) else [0.0] * len(sizes)
    block = max(block_words, -(-int(sum(goal)) // MAX_BLOCKS))
    rng, table, quotas = np.random.default_rng(seed), [], []
    for r, size, t in zip(totals, sizes, goal, strict=True):
        rounds = min(max_repeat, int(t // size)) if size else 0
        rest = max(0.0, t - rounds * size)
        n = -(-size // block)
        part = min(n, round(rest / block))
        quotas.append(rounds * n + part)
        table.append([r["source"], size, float(t), rounds, part, max(1, n),
                      _coprime(max(1, quotas[-1]), rng), max(1, quotas[-1])])
    cuts = np.cumsum(split_quotas(quotas, shards, seed), axis=0).T.tolist() if table else []
    plan_schema = ("_source string, source_size long, target double, rounds int, part long, n_blocks long, "
                   "mult long, quota long, cuts array<long>")
    sources = spark.createDataFrame([(*t, c) for t, c in zip(table, cuts, strict=True)], plan_schema)
    copies = (rows.groupBy(*_KEY, "size").agg(F.count("*").alias("copies"))
              .withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "h1", "h2"))
              .withColumn("words", F.col("size") * F.col("copies")))
    laid = numbered(copies, ["source"], ["place", "doc_id", "h1", "h2"], amount="words", before="start")
    on = laid.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return rows, on.withColumn("first", F.floor(F.col("start") / F.lit(block)).cast("long")), block


def _shard(number: Column) -> Column:
    """The shard that draws a source's block number."""
    drawn = F.pmod(F.col("mult") * number, F.col("quota"))
    return F.size(F.filter("cuts", lambda c: c <= drawn)).cast("int")


def _blocks(laid: DataFrame, block: int) -> DataFrame:
    """One row per document, round and drawn block: block (its number in the source),
    block_words (of the document in it, all copies), block_shard and shuffle_key. A document
    without any has one row of nulls."""
    last = F.floor((F.col("start") + F.col("words") - 1) / F.lit(block)).cast("long")
    upto = F.when(F.col("words") > 0, F.when(F.col("round") < F.col("rounds"), last).otherwise(F.least(last, F.col("part") - 1)))
    turn = laid.withColumn("round", F.explode(F.sequence(F.lit(0), F.col("rounds")))).withColumn("_upto", upto)
    some = turn.withColumn("_from", F.explode_outer(
        F.when(F.col("_upto") >= F.col("first"), F.sequence("first", "_upto", F.lit(_LISTED).cast("long")))))
    each = some.withColumn("_b", F.explode_outer(
        F.when(F.col("_from").isNotNull(), F.sequence("_from", F.least("_upto", F.col("_from") + (_LISTED - 1))))))
    words = F.least(F.col("start") + F.col("words"), (F.col("_b") + 1) * block) - F.greatest("start", F.col("_b") * block)
    number = F.col("round") * F.col("n_blocks") + F.col("_b")
    return each.withColumn("block", number).withColumn("block_words", F.when(F.col("_b").isNotNull(), words)).withColumn(
        "block_shard", F.when(F.col("_b").isNotNull(), _shard(F.col("block")))).withColumn(
        "shuffle_key", F.when(F.col("_b").isNotNull(), F.xxhash64("place", "block")))


def mix_blocks(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
               block_words: int = BLOCK_WORDS, shards: int = 8, seed: int = 17, id_col: str = "doc_id",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The drawn blocks, a row for each document in each: shard, shuffle_key (the order
    inside a shard), source, block (number among the source's drawn ones), round, doc_id and words."""
    _, laid, block = _laid(docs, weights, max_repeat, block_words, shards, seed, id_col, source_col, text_col)
    return _blocks(laid, block).where("block is not null").select(
        F.col("block_shard").alias("shard"), "shuffle_key", "source", "block", "round", "doc_id",
        F.col("block_words").cast("long").alias("words"))


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
             block_words: int = BLOCK_WORDS, shards: int = 8, seed: int = 17, id_col: str = "doc_id",
             source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, plan). ``rows``: doc_id, source, h1, h2, size of each document.
    ``plan``: for each distinct one of these, target, source_size, rounds, partial
    (words of each copy in the last, partial round) and more (how many of the copies
    take one word beyond them), shard (of its first block; null if nothing is taken), dealt
    (shard:words, all copies, of its drawn blocks), and shard and shuffle_key of each
    round (turns)."""
    rows, laid, block = _laid(docs, weights, max_repeat, block_words, shards, seed, id_col, source_col, text_col)
    one = [*_KEY, "size", "copies", "place", "words", "source_size", "target", "rounds", "n_blocks", "mult", "quota", "cuts", "first"]
    parts = _blocks(laid, block).groupBy(*one, "block_shard").agg(F.sum("block_words").alias("_drawn"))
    told = F.concat_ws(":", "block_shard", "_drawn")
    drawn = parts.groupBy(*one).agg(
        F.coalesce(F.sum("_drawn"), F.lit(0)).alias("drawn"),
        F.array_sort(F.collect_list(F.when(F.col("block_shard").isNotNull(), F.struct("block_shard", told.alias("t"))))).alias("_dealt"))
    extra = F.expr("drawn - rounds * words")
    turns = F.transform(F.sequence(F.lit(0), F.col("rounds")), lambda r: F.struct(
        _shard(r * F.col("n_blocks") + F.col("first")).alias("shard"),
        F.xxhash64("place", r * F.col("n_blocks") + F.col("first")).alias("shuffle_key")))
    plan = drawn.withColumn("extra", extra).withColumn("turns", turns).select(
        *_KEY, "size", "source_size", "target", "rounds", F.expr("extra div copies").alias("partial"),
        F.expr("extra % copies").alias("more"), "turns", F.when(F.col("drawn") > 0, F.col("turns")[0]["shard"]).alias("shard"),
        F.array_join(F.transform("_dealt", lambda d: d["t"]), " ").alias("dealt"))
    return rows, plan


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its size, its source's size and target, the words taken
    from it, and the shards that its drawn blocks are dealt to."""
    rows, plan = plan_mix(docs, **options)
    plan = stable(plan.drop("size")).select(*[F.col(c).alias(f"_{c}") for c in _KEY], "source_size", "target", "rounds",
                                            "partial", "more", "shard", "dealt")
    rows = stable(numbered(rows, _KEY, [], index="copy"))
    cond = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    cond = cond & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
    partial = F.col("partial") + (F.col("copy") < F.col("more")).cast("long")
    taken = (F.col("rounds") * F.col("size") + partial).cast("long")
    return rows.join(plan, cond).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "rounds", partial.alias("partial"),
        F.when(taken > 0, F.col("shard")).alias("shard"), "dealt")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  chars_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once per round it is
    taken whole, and its leading words (white space between them kept) for a partial
    one, shard by shard and shuffled there. Documents without words are not in a mix of
    words and go."""
    own = [id_col, source_col, text_col, *([chars_col] if chars_col else [])]
    return shielded(docs, own, lambda d: _mixed(d, id_col, source_col, text_col, chars_col, options)).select(
        *[f"`{c}`" for c in docs.columns])


def _mixed(docs: DataFrame, id_col: str, source_col: str, text_col: str, chars_col: str | None, options: dict) -> DataFrame:
    _, plan = plan_mix(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    plan = stable(plan.where("size > 0 and (rounds > 0 or partial > 0 or more > 0)").select(
        *[F.col(c).alias(f"_{c}") for c in [*_KEY, "size", "rounds", "partial", "more", "turns"]]))
    text = F.col(text_col)
    keyed = docs.withColumn("_t1", F.xxhash64(F.coalesce(text, F.lit("")))).withColumn(
        "_t2", F.xxhash64(F.lit(11), F.coalesce(text, F.lit(""))))
    cond = (F.col("_t1") == F.col("_h1")) & (F.col("_t2") == F.col("_h2"))
    cond = cond & F.col(id_col).eqNullSafe(F.col("_doc_id")) & F.col(source_col).eqNullSafe(F.col("_source"))
    uneven = plan.where("_more > 0")
    if uneven.isEmpty():
        keyed = keyed.withColumn("_copy", F.lit(0).cast("long"))
    else:  # only copies that differ are numbered
        plain = keyed.join(uneven, cond, "left_anti").withColumn("_copy", F.lit(0).cast("long"))
        copies = numbered(keyed.join(uneven, cond, "left_semi"), [id_col, source_col, "_t1", "_t2"], [], index="_copy")
        keyed = plain.unionByName(copies)
    plan = plan.withColumnRenamed("_partial", "_least")
    keyed_plan = keyed.join(plan, cond).withColumn("_partial", F.col("_least") + (F.col("_copy") < F.col("_more")).cast("long"))
    count = F.col("_rounds") + (F.col("_partial") > 0).cast("int")
    each = keyed_plan.where(count > 0).select("*", F.posexplode(F.slice("_turns", 1, count)).alias("_round", "_turn"))
    each = each.withColumn("_cut", (F.col("_round") == F.col("_rounds")) & (F.col("_partial") < F.col("_size")))
    lead = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1,
                                F.col("_partial").cast("int")), "")
    out = each.withColumn(text_col, F.when(F.col("_cut"), lead).otherwise(text))
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col("_cut"), F.char_length(text_col).cast(docs.schema[chars_col].dataType))
                             .otherwise(F.col(chars_col)))
    return out.orderBy("_turn.shard", "_turn.shuffle_key").select(*docs.columns)
