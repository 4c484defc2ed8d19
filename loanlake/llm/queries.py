"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .alignment import align_tokenizers
from .ann import nearest
from .automaton_dedup import remove_passages
from .jaccard_join import jaccard_components
from .langid import language_id
from .linededup import dedup_lines
from .mixing import mix_report
from .oracle import ORACLE
from .packing import pack_documents
from .prefix_trie import ordered_turns, prefix_trie, share_heads
from .quality import quality_rules
from .sharding import shard_documents
from .suffix_dedup import remove_repeats
from .toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_jaccard_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir))


def op2_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op3_collision_counting_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op4_divergence_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir))


def op5_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_documents(spark, sf_dir), shards=24)


def op6_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(_documents(spark, sf_dir))


def op7_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


def op9_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir))


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), tokenizer_path())


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*share_heads(ordered_turns(_table(spark, sf_dir, "conversations")))).drop("turn_digest")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_documents(spark, sf_dir), tokenizer_path(), piece_path())[0]


def op13_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_jaccard_trie_join, op2_recurrent_toxicity, op3_collision_counting_ann, op4_divergence_quality,
    op5_hash_tree_shards, op6_hypergeometric_mix, op7_rank_order_langid, op8_line_windows,
    op9_difference_cover_dedup, op10_harmonic_packing,
    op11_conversation_prefix_trie, op12_cross_tokenizer_alignment, op13_automaton_dedup)}

__all__ = ["ORACLE", "QUERIES", "piece_path", "tokenizer_path"]
