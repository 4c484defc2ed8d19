"""The training-data pipeline: language ID, line dedup, near-duplicate removal,
mixing to target weights, packing. Each stage reads what its predecessor wrote.
Columns beyond those of documents pass through the stages unchanged."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import shielded
from loanlake.llm.jaccard_join import keep_one_each
from loanlake.llm.langid import UNKNOWN, language_id
from loanlake.llm.linededup import dedup_lines
from loanlake.llm.mixing import mix_documents
from loanlake.llm.packing import pack_documents
from loanlake.llm.queries import tokenizer_path
from loanlake.plans.tables import remove
from loanlake.session import ensure_checkpoint_dir

#: A text whose n-grams are this far from every profile is in no learned language.
MIN_LANGUAGE_SCORE = 0.1
#: What stages read.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those near no language; the lang column stays as it is."""
    def known(d: DataFrame) -> DataFrame:
        scored = language_id(d)
        return scored.where((scored["lang_pred"] != UNKNOWN) & (scored["score"] >= MIN_LANGUAGE_SCORE)).select(*d.columns)

    return shielded(docs, DOCUMENT_COLUMNS, known)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out later occurrences of repeated line windows; a document left without a word goes."""
    def lines(d: DataFrame) -> DataFrame:
        kept = dedup_lines(d).where("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
        if "n_chars" in d.columns:
            kept = kept.withColumn("n_chars", F.expr("case when n_removed = 0 then n_chars else char_length(text) end"))
        return kept.select(*d.columns)

    return shielded(docs, DOCUMENT_COLUMNS, lines)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that Jaccard links connect stays."""
    return keep_one_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffled, so that the rounds of a repeated document don't share a sequence."""
    return pack_documents(docs, tokenizer_path(), shuffled=True)


STAGES = [("language_id", keep_known_languages), ("line_dedup", remove_repeated_lines),
          ("near_copies", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: Language profiles, random draws and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = f"{base}/{k}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # nothing reads the stage before the last written one any more
            remove(spark, before)
        before = path
    return docs
